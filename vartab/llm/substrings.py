"""Removal of repeated word windows behind a count-min prefilter (operator 4).

A window is ``WINDOW`` consecutive words of one text; words covered by a window
whose word sequence also starts earlier (smaller doc_id, or earlier in the same
row) are removed. Three rounds between blocks of texts and shards of the hash
space, in one plan; the texts are dealt into blocks by one shuffle, which all
three rounds read:

1. every block sends each shard its count-min sketch: the occupied cells of a
   counter row of 2**CELL_BITS cells, with a flag for cells it met twice. The
   sketch is sparse (about 2.5 bytes a window after the shuffle's compression).
   The shard adds the sketches up and answers, per block, which of its cells
   count two or more. A cell counts at least as often as each window in it, so
   a window that repeats is always among these;
2. every block sends the windows in such cells, once each, with 96 bits of hash
   (over 64-bit hashes of the words) and the smallest doc_id; the shard groups them
   by these bits, which stand for the words, and answers which blocks hold the
   smallest doc_id;
3. every block removes the words covered by repeated windows.

A window met in any number of texts is one entry per block, so no group grows
with the copies. Answers are bitmaps in the order of what was sent.
"""

from __future__ import annotations

import hashlib
import struct
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.llm.words import Words, hash_windows, hash_words, second_hash

WINDOW = 20
CELL_BITS = 38
BLOCK_BYTES = 8 << 20
SHARD_WINDOWS = 4 << 20
MESSAGE = "block int, shard int, kind int, body binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_SCHEMA = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])
_NULL_ID = -(1 << 63)  # a null id is the smallest


def _messages(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA, strict=True)], schema=_SCHEMA)


def _cuts(h: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of the shards in sorted hashes: shard s holds [s, s + 1) / shards of the space."""
    bounds = [min(-(-(s << 64) // shards) >> 26 << 26, (1 << 64) - 1) for s in range(1, shards)]
    return np.concatenate([[0], np.searchsorted(h, np.array(bounds, np.uint64)), [len(h)]])


def pack_cells(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted cells as byte planes of their differences, and a flag each."""
    deltas = np.diff(cells, prepend=np.uint64(0))
    first, deltas = int(deltas[0]), deltas.copy()
    deltas[0] = 0
    planes = max(1, (int(deltas.max()).bit_length() + 7) // 8)
    body = deltas.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()
    return struct.pack("<QIB", first, len(cells), planes) + body + np.packbits(twice).tobytes()


def unpack_cells(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    first, n, planes = struct.unpack_from("<QIB", body)
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :planes] = np.frombuffer(body, np.uint8, n * planes, 13).reshape(planes, n).T
    cells = np.cumsum(raw.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64(first)
    return cells, np.unpackbits(np.frombuffer(body, np.uint8, offset=13 + n * planes), count=n).astype(bool)


class _Block:
    """The texts of a block in id order, their words and windows."""

    def __init__(self, table: pa.Table, window: int):
        ids = table["doc_id"].fill_null(_NULL_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        texts = table["text"].to_pylist()
        self.ids = ids[order]
        self.texts = [(texts[i] or "").encode("utf-8", "replace") for i in order]
        self.words: Words = hash_words(self.texts)
        self.h, self.start = hash_windows(self.words, window)
        self.window = window

    def sketch(self) -> tuple[np.ndarray, np.ndarray]:
        cells, counts = np.unique(self.h >> np.uint64(64 - CELL_BITS), return_counts=True)
        return cells, counts > 1

    def suspects(self, answers: dict[int, bytes], shards: int) -> dict[str, np.ndarray]:
        """The windows in cells that count twice or more, grouped by content: in
        each group by id, row and start, since that is the order of the windows."""
        cells, _ = self.sketch()
        cuts = _cuts(cells << np.uint64(64 - CELL_BITS), shards)
        often = np.zeros(len(cells), bool)
        for s, body in answers.items():
            n = cuts[s + 1] - cuts[s]
            often[cuts[s]:cuts[s + 1]] = np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)
        at = np.flatnonzero(often[np.searchsorted(cells, self.h >> np.uint64(64 - CELL_BITS))]) if len(cells) \
            else np.empty(0, np.int64)
        h1, start = self.h[at], self.start[at]
        h2 = second_hash(self.words, self.window, start)
        order = np.lexsort((h2, h1))
        h1, h2, start = h1[order], h2[order], start[order]
        row = np.searchsorted(self.words.first, start, side="right") - 1
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        return {"h1": h1, "h2": h2, "start": start, "row": row, "new": new, "id": self.ids[row]}


def _block_of(table: pa.Table) -> int:
    return table["block"][0].as_py()


def _answers(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {s: b for s, k, b in zip(table["shard"].to_pylist(), table["kind"].to_pylist(),
                                    table["body"].to_pylist(), strict=True) if k == kind}


def send_sketch(table: pa.Table, window: int, shards: int) -> pa.Table:
    cells, twice = _Block(table, window).sketch()
    cuts, block = _cuts(cells << np.uint64(64 - CELL_BITS), shards), _block_of(table)
    return _messages([(block, s, 0, pack_cells(cells[a:b], twice[a:b]))
                      for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a])


def add_sketches(table: pa.Table) -> pa.Table:
    """One shard: the summed sketch, answered per block."""
    blocks, got = table["block"].to_pylist(), [unpack_cells(b) for b in table["body"].to_pylist()]
    cells = np.concatenate([c for c, _ in got])
    every, counts = np.unique(cells, return_counts=True)
    often = counts > 1
    for c, twice in got:
        often[np.searchsorted(every, c[twice])] = True
    shard = table["shard"][0].as_py()
    return _messages([(b, shard, 1, np.packbits(often[np.searchsorted(every, c)]).tobytes())
                      for b, (c, _) in zip(blocks, got, strict=True)])


def send_suspects(texts: pa.Table, answers: pa.Table, window: int, shards: int) -> pa.Table:
    if not texts.num_rows or not answers.num_rows:
        return _messages([])
    found = _Block(texts, window).suspects(_answers(answers, 1), shards)
    h1, h2, ids = (found[k][found["new"]] for k in ("h1", "h2", "id"))
    cuts, block = _cuts(h1, shards), _block_of(texts)
    return _messages([(block, s, 2, h1[a:b].tobytes() + ids[a:b].astype(np.int64).tobytes() + h2[a:b].tobytes())
                      for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a])


def group_suspects(table: pa.Table) -> pa.Table:
    """One shard: per block, a bit for each window sent: its id is the smallest."""
    blocks, bodies = table["block"].to_pylist(), table["body"].to_pylist()
    sizes = [len(b) // 20 for b in bodies]
    h1 = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(bodies, sizes, strict=True)])
    ids = np.concatenate([np.frombuffer(b, np.int64, n, 8 * n) for b, n in zip(bodies, sizes, strict=True)])
    h2 = np.concatenate([np.frombuffer(b, np.uint32, n, 16 * n) for b, n in zip(bodies, sizes, strict=True)])
    order = np.lexsort((ids, h2, h1))
    a, b, c = h1[order], h2[order], ids[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = c[new][np.cumsum(new) - 1]
    is_least = np.empty(len(a), bool)
    is_least[order] = c == least
    ends, shard = np.cumsum(sizes), table["shard"][0].as_py()
    return _messages([(blk, shard, 3, np.packbits(is_least[e - n:e]).tobytes())
                      for blk, n, e in zip(blocks, sizes, ends, strict=True)])


def remove_covered(texts: pa.Table, answers: pa.Table, window: int, shards: int) -> pa.Table:
    if not texts.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                         "n_removed": pa.array([], pa.int64()), "kept_sha256": pa.array([], pa.string()),
                         "kept": pa.array([], pa.string())})
    block = _Block(texts, window)
    found = block.suspects(_answers(answers, 1), shards)
    new, row, ids = found["new"], found["row"], found["id"]
    total = len(block.words.hashes)
    change = np.zeros(total + 1, np.int64)
    if len(new):
        group = np.cumsum(new) - 1
        cuts, least_here = _cuts(found["h1"][new], shards), np.zeros(int(new.sum()), bool)
        for s, body in _answers(answers, 3).items():
            n = cuts[s + 1] - cuts[s]
            least_here[cuts[s]:cuts[s + 1]] = np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)
        opens = new.copy()
        opens[1:] |= row[1:] != row[:-1]  # first of its row in the group
        stays = least_here[group] & (ids == ids[new][group]) & opens
        gone = found["start"][~stays]
        np.add.at(change, gone, 1)
        np.add.at(change, gone + window, -1)
    keep = np.cumsum(change[:-1]) == 0
    kept = []
    for i, text in enumerate(block.texts):
        part = text.split()
        mine = keep[block.words.first[i]:block.words.first[i + 1]]
        kept.append(b" ".join(part if mine.all() else compress(part, mine)))
    sums = np.concatenate([[0], np.cumsum(keep)])[block.words.first]
    n_words = block.words.counts()
    return pa.table({
        "doc_id": pa.array([None if i == _NULL_ID else i for i in block.ids.tolist()], pa.int64()),
        "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_words - np.diff(sums), pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        "kept": pa.array([k.decode() for k in kept], pa.string())})


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                     with_text: bool = False, block_bytes: int = BLOCK_BYTES,
                     shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (and ``kept``, the text that is left).

    Defined cases: a null or empty text has no words; texts shorter than a window
    lose nothing; a null doc_id is smaller than any other; rows that share a
    doc_id don't come before one another, so each keeps its own first windows;
    an empty table gives no rows. Other columns are not read, whatever their
    names. Hashing is done in pieces, so a text may be longer than a block."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // block_bytes))
    shards = max(1, -(-size // 7 // shard_windows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def by_block(frame: DataFrame):
        return frame.groupBy("block")

    sketches = by_block(dealt).applyInArrow(lambda t: send_sketch(t, window, shards), MESSAGE)
    often = sketches.groupBy("shard").applyInArrow(add_sketches, MESSAGE)
    suspects = by_block(dealt).cogroup(by_block(often)).applyInArrow(
        lambda a, b: send_suspects(a, b, window, shards), MESSAGE)
    least = suspects.groupBy("shard").applyInArrow(group_suspects, MESSAGE)
    fields = RESULT + (", kept string" if with_text else "")
    names = [f.split()[0] for f in fields.split(", ")]
    return by_block(dealt).cogroup(by_block(often.unionByName(least))).applyInArrow(
        lambda a, b: remove_covered(a, b, window, shards).select(names), fields)
