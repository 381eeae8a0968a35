"""Token ids packed into fixed rows, best fit decreasing (operator 5).

Texts are encoded, split losslessly into segments of at most ``row_tokens`` ids
and packed into rows of that length: segments go in order of decreasing length
into the row with the least room that still holds them. That row is found in a
segment tree over capacities (how many open rows have each amount of room; a
node knows whether any leaf below is occupied), in logarithmic time. Packing is
done per chunk of about ``CHUNK_TOKENS`` ids of a partition, so no task holds
more, no rows are moved between tasks, and at most the last rows of a chunk are
left part-filled.

A packed row holds its ids padded to full length (little-endian), cumulative
segment lengths (0 first), the position of each id within its segment (so
positions reset at segment starts) and which part of which text each segment is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_TOKENS = 2048
CHUNK_TOKENS = 4 << 20
BATCH_BYTES = 4 << 20
LONG_BLANKS = 1000
# White space of the pattern (the Unicode property), in runs that the library's regular
# expression would track back through.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_BLANKS)

SCHEMA = ("partition int, chunk int, row int, n_tokens int, n_segments int, cu_seqlens array<int>, "
          "doc_ids array<long>, doc_rows array<long>, doc_starts array<int>, input_ids binary, position_ids binary, "
          "ids_sha256 string")


class Coder:
    """Encodes texts by the library. A long run of white space is one match of the
    pattern, less its last sign if something follows, and is encoded as such, since the
    library gives up on runs of a million."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        out, at = [], 0
        for run in _BLANKS.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += self.words.encode_ordinary(text[at:run.start()])
            out += self.whole.encode_ordinary(text[run.start():end])
            at = end
        return out + self.words.encode_ordinary(text[at:])


class RoomTree:
    """A segment tree over room 0..most: counts of open rows by room, with a stack
    of the rows at each leaf."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of an open row with the least room of at least ``need``."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1  # up until there is an occupied right neighbour
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def pack(lengths: list[int], row_tokens: int) -> list[list[int]]:
    """Best fit decreasing: the segments (by index) of each row, longest first;
    equal lengths in index order. Segments of no ids are not packed."""
    rows: list[list[int]] = []
    tree = RoomTree(row_tokens)
    for i in sorted((i for i, n in enumerate(lengths) if n), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            found = row_tokens, len(rows)
            rows.append([])
        rows[found[1]].append(i)
        if left := found[0] - lengths[i]:
            tree.add(left, found[1])
    return rows


def pack_chunk(ids: list[np.ndarray], names: list[tuple[int | None, int]], row_tokens: int, pad_id: int,
               dtype: str) -> dict[str, list]:
    """The packed rows of some texts; ``names`` are (doc_id, row in the partition)."""
    segments = [(t, a, min(a + row_tokens, len(x))) for t, x in enumerate(ids) for a in range(0, len(x), row_tokens)]
    out: dict[str, list] = {f.split()[0]: [] for f in SCHEMA.split(", ")[2:]}
    for number, members in enumerate(pack([b - a for _, a, b in segments], row_tokens)):
        parts = [segments[i] for i in members]
        sizes = [b - a for _, a, b in parts]
        matrix, positions = np.full(row_tokens, pad_id, dtype), np.zeros(row_tokens, dtype)
        used = sum(sizes)
        matrix[:used] = np.concatenate([ids[t][a:b] for t, a, b in parts])
        positions[:used] = np.concatenate([np.arange(n) for n in sizes])
        row = {"row": number, "n_tokens": used, "n_segments": len(parts), "cu_seqlens": np.cumsum([0, *sizes]).tolist(),
               "doc_ids": [names[t][0] for t, *_ in parts], "doc_rows": [names[t][1] for t, *_ in parts],
               "doc_starts": [a for _, a, _ in parts], "input_ids": matrix.tobytes(), "position_ids": positions.tobytes(),
               "ids_sha256": hashlib.sha256(matrix.tobytes()).hexdigest()}
        for k, v in row.items():
            out[k].append(v)
    return out


_TYPES = {"partition": pa.int32(), "chunk": pa.int32(), "row": pa.int32(), "n_tokens": pa.int32(), "n_segments": pa.int32(),
          "cu_seqlens": pa.list_(pa.int32()), "doc_ids": pa.list_(pa.int64()), "doc_rows": pa.list_(pa.int64()),
          "doc_starts": pa.list_(pa.int32()), "input_ids": pa.binary(), "position_ids": pa.binary(),
          "ids_sha256": pa.string()}


def pack_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, row_tokens: int = ROW_TOKENS,
                pad_id: int | None = None, chunk_tokens: int = CHUNK_TOKENS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The packed rows of all texts (see SCHEMA); (partition, chunk, row) names a
    row. Which texts share a row depends on the partitions of ``docs``. Ids are 16-bit where the vocabulary and the padding fit, else 32-bit.

    Defined cases: a null or empty text has no ids and is in no row; a text longer
    than a row becomes several segments, whose doc_starts tell their order; runs of
    white space may be of any length; null
    and repeated doc_ids are told apart by doc_rows, the number of the input row
    in its partition; an empty table gives no rows. Other columns are not read."""
    pad = max(ranks.values()) + 1 if pad_id is None else pad_id
    dtype = "<u2" if max(pad, max(ranks.values()), row_tokens) < 1 << 16 else "<u4"
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: some 50,000 tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(sent.value, pattern)
        part = TaskContext.get().partitionId()
        ids, names, held, chunk, seen = [], [], 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            out = pack_chunk(ids, names, row_tokens, pad, dtype)
            n = len(out["row"])
            for a in range(0, n, 2000):
                cols = {"partition": [part] * n, "chunk": [chunk] * n, **out}
                yield pa.RecordBatch.from_pydict({k: pa.array(v[a:a + 2000], _TYPES[k]) for k, v in cols.items()})

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                x = np.array(coder.encode(text or ""), dtype)
                if held and held + len(x) > chunk_tokens:
                    yield from flush()
                    ids, names, held, chunk = [], [], 0, chunk + 1
                ids.append(x)
                names.append((doc, seen))
                held, seen = held + len(x), seen + 1
        yield from flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def write_rows(packed: DataFrame, path: str) -> None:
    """Writes the packed rows as Parquet under ``path``: ``input_ids`` and
    ``position_ids`` are binary columns of fixed size, so a file is a matrix of
    ids row by row, with its cumulative lengths and sources beside it."""
    packed.write.parquet(path)
