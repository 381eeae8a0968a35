"""Byte-level BPE encoding and decoding with DuckDB inside the tasks (operator 2).

Spark deals the rows; in a task the words (matches of the tokenizer's pattern)
of a batch that are not known yet go to an in-memory DuckDB. There a word is
rows (word, position, token id), at first one per byte; each step of a
recursive query joins neighbouring rows with the merge table, takes the least
rank of each word and contracts its pairs of that rank from the left, until no
pair of the word can merge. A word that is in the vocabulary whole is its id.
Decoding joins (text, position, id) rows with the token table and aggregates
the bytes in order.

Words are cut beforehand between bytes that are neighbours in no token, as no
merge can span them; that keeps very long words short. Known words are kept in
a cache of each Python worker, bounded by ``CACHE_WORDS``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 1_000_000
BATCH_BYTES = 8 << 20
ROWS_PER_QUERY = 1 << 20  # at most; positions stay below 2**21 unless one word is longer
ROWS_PER_BATCH = 500
LONG_WORD = 100

# One step contracts the leftmost pair of the least rank of each word.
ENCODE_SQL = """
WITH RECURSIVE step(word, pos, id, done) AS (
    SELECT word, pos, id, false FROM start
    UNION ALL
    (WITH rows AS MATERIALIZED (
        SELECT word, pos, id, lag(pos) OVER w AS before, lead(id) OVER w AS next_id
        FROM step WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)),
    least AS (
        SELECT word, min(m.merged::BIGINT << 21 | pos) AS key
        FROM rows r JOIN merges m ON m.pair = (r.id::BIGINT << 20 | r.next_id) GROUP BY word)
    SELECT r.word, r.pos, CASE WHEN key & 2097151 = r.pos THEN (key >> 21)::INT ELSE r.id END, key IS NULL
    FROM rows r LEFT JOIN least ON least.word = r.word
    WHERE key IS NULL OR r.before IS NULL OR r.before <> (key & 2097151)))
SELECT pos, id FROM step WHERE done ORDER BY pos
"""
# The same for long words, which need fewer steps this way: all pairs of the
# least rank at once, of overlapping ones the first, third, ...
ENCODE_LONG_SQL = """
WITH RECURSIVE step(word, pos, id, done) AS (
    SELECT word, pos, id, false FROM start
    UNION ALL
    SELECT word, pos, id, done FROM (
        SELECT word, pos, CASE WHEN merges THEN least ELSE id END AS id, least IS NULL AS done,
               coalesce(lag(merges) OVER (PARTITION BY word ORDER BY pos), false) AS swallowed
        FROM (
            SELECT word, pos, id, least, rank = least AND (nth - coalesce(max(
                CASE WHEN rank IS DISTINCT FROM least THEN nth END) OVER (PARTITION BY word ORDER BY pos), 0)) % 2 = 1 AS merges
            FROM (
                SELECT n.word, n.pos, n.id, n.nth, m.merged AS rank, min(m.merged) OVER (PARTITION BY n.word) AS least
                FROM (
                    SELECT word, pos, id, row_number() OVER (PARTITION BY word ORDER BY pos) AS nth,
                           lead(id) OVER (PARTITION BY word ORDER BY pos) AS next_id
                    FROM step WHERE NOT done) n
                LEFT JOIN merges m ON m.pair = (n.id::BIGINT << 20 | n.next_id))))
    WHERE NOT swallowed)
SELECT pos, id FROM step WHERE done ORDER BY pos
"""
DECODE_SQL = """
SELECT text, string_agg(t.hex, '' ORDER BY i.pos) AS hex
FROM ids i JOIN tokens t ON t.id = i.id GROUP BY text ORDER BY text
"""


class Vocabulary:
    """Ranks and pattern of a tokenizer; the database and the cache (ids by word
    and by chunk) are made in the process that uses them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_words: int = CACHE_WORDS,
                 space_starts_word: bool = True, batch_bytes: int = BATCH_BYTES):
        """``space_starts_word``: a space between two other characters always starts
        a match of the pattern (true of the given one, where a space is optional
        before letters, numbers and signs, and white space yields its last).
        ``cache_words`` and ``batch_bytes`` bound what a Python worker holds: a
        million words take some 250 MB, a batch some twenty times its bytes."""
        self.batch_bytes = batch_bytes
        self.ranks, self.pattern, self.cache_words = ranks, pattern, cache_words
        self.space_starts_word = space_starts_word
        self._con = None

    @classmethod
    def load(cls, path: str, pattern: str, **bounds: int) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}, pattern, **bounds)

    def _open(self) -> None:
        ranks = self.ranks
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        self._words = regex.compile(self.pattern)
        self._wide, self._cut = regex.compile(r" \s|\s "), regex.compile(r"(?<=\S) (?=\S)")
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._joins = np.zeros(1 << 16, bool)  # byte pairs that some token holds
        pairs, merged = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                self._joins[token[i - 1] << 8 | token[i]] = True
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left << 20 | right)
                    merged.append(rank)
        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "700MB", "temp_directory": ""})
        self._load(con, "merges", pair=pa.array(pairs, pa.int64()), merged=pa.array(merged, pa.int32()))
        self._load(con, "tokens", id=pa.array(list(ranks.values()), pa.int32()),
                   hex=pa.array([t.hex() for t in ranks], pa.string()))
        self._cache: dict[str, bytes] = {}
        self._con = con

    @staticmethod
    def _load(con, name: str, **columns: pa.Array) -> None:
        con.register("given", pa.table(columns))
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        con.unregister("given")

    def _contract(self, words: list[bytes], query: str) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers, by ``query``."""
        data = np.frombuffer(b"".join(words), np.uint8)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        cut = np.ones(len(data), bool)
        cut[1:] = (owner[1:] != owner[:-1]) | ~self._joins[data[:-1].astype(np.int32) << 8 | data[1:]]
        start = pa.table({"word": pa.array(np.cumsum(cut), pa.int32()), "pos": pa.array(np.arange(len(data)), pa.int32()),
                          "id": pa.array(self._byte[data], pa.int32())})
        self._con.register("start", start)
        out = self._con.execute(query).fetchnumpy()
        self._con.unregister("start")
        ids = np.asarray(out["id"]).astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(owner[np.asarray(out["pos"])], minlength=len(words)))
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _word_ids(self, words: set[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        short, long = [], []
        for word in words:
            data = word.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                out[word] = rank.to_bytes(4, "little")
            else:
                (long if len(data) > LONG_WORD else short).append(word)
        most = min(ROWS_PER_QUERY, max(1 << 16, self.batch_bytes // 8))
        for pending, query in ((short, ENCODE_SQL), (long, ENCODE_LONG_SQL)):
            at = 0
            while at < len(pending):
                part, size = [], 0
                while at < len(pending) and (not part or size + 4 * len(pending[at]) <= most):
                    part.append(pending[at].encode())
                    size += len(part[-1])
                    at += 1
                out.update(zip(pending[at - len(part):at], self._contract(part, query), strict=True))
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Puts the ids of chunks (runs of words), and of their words, into the cache."""
        if len(self._cache) + len(chunks) > self.cache_words:
            self._cache = {}
        cache, words, split = self._cache, set(), {}
        for c in chunks:
            # letters of the Latin blocks after an optional space are surely one word
            if self.space_starts_word and c[1:].isalpha() and max(c) < "\u0250" and (c[0] == " " or c[0].isalpha()):
                words.add(c)
            else:
                split[c] = self._words.findall(c)
        words.update(*split.values())
        cache.update(self._word_ids(words.difference(cache)))
        for chunk, parts in split.items():
            if len(parts) != 1:
                cache[chunk] = b"".join(map(cache.__getitem__, parts))

    def _chunks(self, texts: list[str]) -> pa.ListArray:
        """Each text as a list of chunks, cut where a word surely starts: before a space
        between two characters that are not white space. A sign found in none of the
        texts marks the cuts; texts that hold all of these signs are one chunk each."""
        joined = "".join(texts)
        sign = next((c for c in map(chr, range(0xE000, 0xF8FF)) if c not in joined), None) if self.space_starts_word else None
        if sign is None:
            return pa.ListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int32()), pa.array(texts, pa.large_string()))
        cut = sign + " "
        marked = [self._cut.sub(cut, t) if self._wide.search(t) else t.replace(" ", cut) for t in texts]
        return pc.split_pattern(pa.array(marked, pa.large_string()), sign)

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        if self._con is None:
            self._open()
        chunks = self._chunks(texts)
        coded = chunks.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        cache = self._cache
        if new := [c for c in distinct if c not in cache]:
            self._learn(new)
            cache = self._cache
            if gone := [c for c in distinct if c not in cache]:  # the cache was full and began anew
                self._learn(gone)
                cache = self._cache
        ids = [cache[c] for c in distinct]
        flat, size = np.frombuffer(b"".join(ids), "<u4"), np.array([len(i) // 4 for i in ids], np.int32)
        begin, code = np.cumsum(size, dtype=np.int32) - size, coded.indices.to_numpy()
        count = size[code]
        upto = np.concatenate([[0], np.cumsum(count, dtype=np.int32)])
        out = flat[np.repeat(begin[code] - upto[:-1], count) + np.arange(upto[-1], dtype=np.int32)]
        return out, np.diff(upto[chunks.offsets.to_numpy()])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode_flat(texts)
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each sequence of ids stands for, by DECODE_SQL."""
        if self._con is None:
            self._open()
        flat = np.frombuffer(b"".join(ids), "<u4")
        if not len(flat):
            return [b""] * len(ids)
        self._con.register("ids", pa.table({
            "text": pa.array(np.repeat(np.arange(len(ids)), [len(i) // 4 for i in ids]), pa.int32()),
            "pos": pa.array(np.arange(len(flat)), pa.int32()), "id": pa.array(flat.astype(np.int32), pa.int32())}))
        rows = self._con.execute(DECODE_SQL).fetchall()
        self._con.unregister("ids")
        out = [b""] * len(ids)
        for text, hexed in rows:
            out[text] = bytes.fromhex(hexed)
        return out


def _slices(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most about ``most`` characters, one text at least."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= most):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def _shared(df: DataFrame, vocabulary: Vocabulary):
    """A function that gives the task its vocabulary. The broadcast (some 50,000
    tokens) is a plain dict that lives as long as the Python worker, which so
    keeps the opened vocabulary, with its word cache, from task to task."""
    sent = df.sparkSession.sparkContext.broadcast({
        "ranks": vocabulary.ranks, "pattern": vocabulary.pattern, "cache_words": vocabulary.cache_words,
        "space_starts_word": vocabulary.space_starts_word, "batch_bytes": vocabulary.batch_bytes})

    def get() -> Vocabulary:
        state = sent.value
        if "opened" not in state:
            state["opened"] = Vocabulary(**state)
        return state["opened"]
    return get


def _run(docs: DataFrame, vocabulary: Vocabulary, keep: list[str], schema: str, make) -> DataFrame:
    get, most = _shared(docs, vocabulary), vocabulary.batch_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS_PER_BATCH):
                batch = whole.slice(i, ROWS_PER_BATCH)
                texts = [t or "" for t in batch["text"].to_pylist()]
                for a, b in _slices(texts, most):
                    made = make(get(), texts[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [batch[c].slice(a, b - a) for c in keep] + list(made.values()), keep + list(made))

    kinds = dict(docs.dtypes)
    fields = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), schema])
    return docs.select(*keep, "text").mapInArrow(run, fields)


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ``ids`` (little-endian 32-bit integers, binary) of every row."""
    def make(v: Vocabulary, texts: list[str]) -> dict:
        ids = v.encode(texts)
        return {"n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _run(rows, vocabulary, ["doc_id"], "n_tokens long, ids binary", make)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and the decoded ``bytes`` of the rows of ``encode``."""
    get = _shared(encoded, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [i or b"" for i in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(get().decode(ids), pa.binary())],
                                             ["doc_id", "bytes"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, encoded and
    decoded again in one pass.

    Defined cases: a null text is an empty one (no tokens, the digests of no
    bytes); null and repeated ids are rows like any other; special tokens are
    ordinary text; an empty table gives no rows. Other columns are not read."""
    def make(v: Vocabulary, texts: list[str]) -> dict:
        ids = v.encode(texts)
        return {"n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in v.decode(ids)], pa.string())}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _run(rows, vocabulary, ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
