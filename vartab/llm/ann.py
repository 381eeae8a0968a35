"""Approximate nearest neighbours by multi-index hashing (operator 3).

Equal vectors are one entry of the index, with the few smallest ids that a result can
need. Vectors become binary codes: rotations learned by iterative quantisation on a
bounded sample (about ``SAMPLE`` vectors, the smallest hashes), ``BITS`` bits in all.
A code is cut into substrings of about log2(n) bits; the index has a row (substring
number, value) -> vector for each. A code within Hamming radius r of a query
differs by at most r // m bits in one of the m substrings (pigeonhole), so the buckets
within t flips of the query's substrings hold every code within m (t + 1) - 1.

Queries are looked up step by step, t = 0, 1, 2, ...: their substrings meet the
index rows by substring and leading bits of the value (a cell), inside a cell by value.
What a step retrieves anew is checked by the whole code and reranked on the original
vectors in double precision: a code further off than the step reaches, or than the
query's k-th best so far, by ``SPREAD`` standard deviations is left out. A query is done once a row at the angle of its k-th best
would have been retrieved with odds of 1 - ``MISS``; the others go on to the next step,
the last of which retrieves all that is left. Cells that hold too many rows for a task
are dealt into parts. Recall is measured in tests/llm against brute force.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vartab.llm.common import stored

BITS = 512
SAMPLE = 8192
CELL_ROWS = 65_536
STEPS = 6            # flips 0 .. STEPS - 1, then all
MISS = 0.08
SPREAD = 2.0         # standard deviations of a code distance that a cut allows for
_CHUNK = 1 << 20     # (query, bucket) tests and (query, row) pairs at a time
_PREFIX = 16         # leading bits that tell a cell, at most


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec array<double>) of the rows whose vector can take part."""
    vec = F.col(vec_col).cast("array<double>")
    fit = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"), fit.alias("fit"))
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce("fit", F.lit(False))).select("vec_id", "vec")


def units(x: np.ndarray) -> np.ndarray:
    """The rows at length one, by way of their largest entry, so nothing overflows."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def learn_rotations(sample: np.ndarray, bits: int = BITS, seed: int = 7, rounds: int = 25) -> np.ndarray:
    """A d x bits projection: rotations fitted so that the signs of unit vectors lose
    little. Nothing is centred, so bits differ in proportion to the angle."""
    d, v = sample.shape[1], units(sample)
    if d > bits and len(v) >= bits:  # leading principal directions first
        basis = np.linalg.svd(v, full_matrices=False)[2][:bits].T
    else:
        basis = np.eye(d)
    v, rng, parts = v @ basis, np.random.default_rng(seed), []
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(rng.normal(size=(basis.shape[1], basis.shape[1])))[0]
        for _ in range(rounds if len(v) > 1 else 0):
            u, _, wt = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ wt).T
        parts.append(basis @ r)
    return np.concatenate(parts, axis=1)[:, :bits]


def encode(x: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes, a row of bytes each."""
    return np.packbits(units(x) @ projection >= 0, axis=1)


def substrings(codes: np.ndarray, size: int) -> np.ndarray:
    """The values of the whole substrings of ``size`` bits of each code."""
    m = codes.shape[1] * 8 // size
    bits = np.unpackbits(codes, axis=1)[:, :m * size].reshape(len(codes), m, size)
    return bits @ (np.int64(1) << np.arange(size - 1, -1, -1, dtype=np.int64))


def reach(flips: int, size: int, m: int, miss: float = MISS) -> float:
    """The largest share of differing bits at which a row is retrieved with odds of
    1 - ``miss`` when all buckets within ``flips`` of m substrings are probed: a
    substring of ``size`` bits has at most ``flips`` that differ."""
    if flips >= size:
        return 1.0

    def missed(p: float) -> float:
        return (1 - sum(math.comb(size, i) * p ** i * (1 - p) ** (size - i) for i in range(flips + 1))) ** m

    low, high = 0.0, 1.0  # missed() rises with the share
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if missed(middle) <= miss else (low, middle)
    return low


def least_cosine(flips: int, size: int, m: int, miss: float = MISS) -> float:
    """The cosine of a row at ``reach``: a bit differs with odds of angle / pi."""
    return math.cos(math.pi * reach(flips, size, m, miss)) if flips < size else -2.0


def cut_of(share: Column) -> Column:
    """The code distance within which nearly all rows lie whose bits differ by ``share``."""
    return F.ceil(BITS * share + SPREAD * F.sqrt(BITS * share * (1 - share))).cast("int")


def near_prefixes(value: np.ndarray, bits: int, flips: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, prefix): the ``bits``-bit numbers within ``flips`` of each value."""
    masks = np.arange(1 << bits, dtype=np.int64)
    masks = masks[np.bitwise_count(masks) <= flips]
    return np.repeat(np.arange(len(value)), len(masks)), (value[:, None] ^ masks[None, :]).ravel()


def search_cell(j: int, size: int, low: int, high: int, uids: np.ndarray, codes: np.ndarray, q_uids: np.ndarray,
                q_codes: np.ndarray, cuts: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(queries, rows, rows probed): pairs whose substring j differs by at most ``high``
    bits, as the first one to do so, and whose codes are within the query's cut; but for
    those that an earlier step had: ``low`` flips in some substring, and within ``before``."""
    subs, q_subs = substrings(codes, size), substrings(q_codes, size)
    order = np.argsort(subs[:, j], kind="stable")
    values, start, count = np.unique(subs[order, j], return_index=True, return_counts=True)
    words, q_words = codes.view(np.uint64), q_codes.view(np.uint64)
    step = max(1, _CHUNK // max(1, len(values)))
    out, probed = [], 0
    for a in range(0, len(q_uids), step):
        own = q_subs[a:a + step, j]
        q, bucket = np.nonzero(np.bitwise_count(values[None, :] ^ own[:, None]) <= high)
        q += a
        ends = np.cumsum(count[bucket])
        probed += int(ends[-1]) if len(ends) else 0
        b = 0
        while b < len(q):  # some buckets at a time
            e = max(b + 1, int(np.searchsorted(ends, (ends[b - 1] if b else 0) + _CHUNK, side="right")))
            n = count[bucket[b:e]]
            first = np.repeat(start[bucket[b:e]] - (np.cumsum(n) - n), n)
            rows, asks = order[first + np.arange(n.sum())], np.repeat(q[b:e], n)
            apart = np.bitwise_count(words[rows] ^ q_words[asks]).sum(1)
            near = apart <= cuts[asks]
            rows, asks, apart = rows[near], asks[near], apart[near]
            flips = np.bitwise_count(subs[rows] ^ q_subs[asks])
            mine = ((flips.min(1, initial=127) > low) | (apart > before[asks])) & (np.argmax(flips <= high, axis=1) == j) & (uids[rows] != q_uids[asks])
            out.append((asks[mine], rows[mine]))
            b = e
    asks = np.concatenate([x for x, _ in out]) if out else np.empty(0, np.int64)
    rows = np.concatenate([x for _, x in out]) if out else np.empty(0, np.int64)
    return asks, rows, probed


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _codes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    body = b"".join(column.to_pylist())
    return np.frombuffer(body, np.uint8).reshape(-1, BITS // 8)


def distinct_vectors(rows: DataFrame, asked: Column, k: int) -> DataFrame:
    """(vec, d, ids, asked): one row per distinct vector, its k + 1 smallest ids (with
    repeats), and whether any row of it is a query. Each task sends at most k + 1 ids
    of a vector."""
    first = Window.partitionBy("vec").orderBy("vec_id")
    ids = (rows.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= k + 1)
           .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    wanted = rows.filter(asked).select("vec").distinct().withColumn("asked", F.lit(True))
    return ids.join(wanted, "vec", "left").select("vec", F.size("vec").alias("d"), "ids", F.coalesce("asked", F.lit(False)).alias("asked"))


def _coded(vectors: DataFrame, models: dict[int, np.ndarray]) -> DataFrame:
    """``vectors`` with their codes, and a number for each."""
    sent = vectors.sparkSession.sparkContext.broadcast(models)  # d x BITS floats per length of vector

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["d"].to_numpy()
            for d in np.unique(sizes):
                part = batch.filter(pa.array(sizes == d))
                codes = encode(_matrix(part["vec"]), sent.value[int(d)])
                yield part.append_column("code", pa.array([c.tobytes() for c in codes], pa.binary()))

    schema = "vec array<double>, d int, ids array<long>, asked boolean, code binary"
    return vectors.mapInArrow(run, schema).withColumn("uid", F.monotonically_increasing_id())


class Index:
    """The multi-index of stored, coded vectors."""

    def __init__(self, vectors: DataFrame, n: int, cell_rows: int = CELL_ROWS):
        self.vectors = vectors
        self.size = min(24, max(8, round(math.log2(max(2, n)))))
        self.m = BITS // self.size
        self.prefix = min(_PREFIX, self.size, max(0, math.ceil(math.log2(max(1, n / cell_rows)))))
        counts = self._placed({}).groupBy("d", "cell").count().filter(F.col("count") > cell_rows)
        self.parts = {(r["d"], r["cell"]): -(-r["count"] // cell_rows) for r in counts.collect()}
        self.rows = self._placed(self.parts)

    def _placed(self, parts: dict[tuple[int, int], int]) -> DataFrame:
        """(d, cell, part, uid, code): a row per vector and substring; a cell is the
        substring's number with the leading bits of its value."""
        size, prefix = self.size, self.prefix

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                subs = substrings(_codes(batch["code"]), size) >> (size - prefix)
                for j in range(subs.shape[1]):
                    cell = (j << prefix) + subs[:, j]
                    part = np.zeros(len(cell), np.int32)
                    for (d, c), n in parts.items():
                        here = (cell == c) & (batch["d"].to_numpy() == d)
                        part[here] = batch["uid"].to_numpy()[here] % n
                    yield pa.RecordBatch.from_arrays([batch["d"], pa.array(cell), pa.array(part), batch["uid"], batch["code"]],
                                                     ["d", "cell", "part", "uid", "code"])

        return self.vectors.select("d", "uid", "code").mapInArrow(run, "d int, cell long, part int, uid long, code binary")

    def probes(self, queries: DataFrame, flips: int) -> DataFrame:
        """(d, cell, part, uid, code, cut, before): a row per query and cell with a bucket within
        ``flips`` of it."""
        size, prefix, parts = self.size, self.prefix, self.parts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                subs, sizes = substrings(_codes(batch["code"]), size) >> (size - prefix), batch["d"].to_numpy()
                for j in range(subs.shape[1]):
                    at, value = near_prefixes(subs[:, j], prefix, flips)
                    cell = (j << prefix) + value
                    n = np.array([parts.get((d, c), 1) for d, c in zip(sizes[at].tolist(), cell.tolist(), strict=True)] if parts else
                                 np.ones(len(at)), dtype=np.int64)
                    at, cell, part = np.repeat(at, n), np.repeat(cell, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    yield pa.RecordBatch.from_arrays(
                        [batch["d"].take(pa.array(at)), pa.array(cell), pa.array(part.astype(np.int32)),
                         *(batch[c].take(pa.array(at)) for c in ("uid", "code", "cut", "before"))],
                        ["d", "cell", "part", "uid", "code", "cut", "before"])

        return queries.select("d", "uid", "code", "cut", "before").mapInArrow(
            run, "d int, cell long, part int, uid long, code binary, cut int, before int")

    def retrieve(self, queries: DataFrame, low: int, high: int) -> DataFrame:
        """(query, uid) of what the buckets within ``high`` flips hold that earlier steps did
        not report, each pair once; and per cell (null, rows probed there), for the record."""
        size, prefix = self.size, self.prefix

        def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
            if not rows.num_rows or not asks.num_rows:
                return pa.table({"query": pa.array([], pa.int64()), "uid": pa.array([], pa.int64())})
            uids, q_uids = rows["uid"].to_numpy(), asks["uid"].to_numpy()
            q, at, probed = search_cell(rows["cell"][0].as_py() >> prefix, size, low, high, uids, _codes(rows["code"]),
                                        q_uids, _codes(asks["code"]), asks["cut"].to_numpy(), asks["before"].to_numpy())
            return pa.table({"query": pa.array(q_uids[q].tolist() + [None], pa.int64()),
                             "uid": pa.array(uids[at].tolist() + [probed], pa.int64())})

        key = ["d", "cell", "part"]
        return (self.rows.groupBy(*key).cogroup(self.probes(queries, high).groupBy(*key))
                .applyInArrow(run, "query long, uid long"))


def _scored(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query, vec_id, score): the cosine of each pair, for each id of the row's vector."""
    asks = vectors.filter("asked").select(F.col("uid").alias("query"), F.col("vec").alias("q"))
    both = pairs.join(asks, "query").join(vectors.select("uid", "vec", "ids"), "uid").select("query", "q", "vec", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, sizes = np.empty(batch.num_rows), pc.list_value_length(batch["vec"]).to_numpy()
            for d in np.unique(sizes):
                here = np.flatnonzero(sizes == d)
                x, q = (_matrix(batch[c].take(pa.array(here))) for c in ("vec", "q"))
                score[here] = (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum(1)))
            each = pc.list_parent_indices(batch["ids"])
            yield pa.RecordBatch.from_arrays([batch["query"].take(each), batch["ids"].flatten(), pa.array(score).take(each)],
                                             ["query", "vec_id", "score"])

    return both.mapInArrow(run, "query long, vec_id long, score double")


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The k + 1 best rows of each query: its own is among them."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return scored.select("query", "vec_id", "score").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)


def nearest(vectors: DataFrame, asked: str = "vec_id % 50 = 0", k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            cell_rows: int = CELL_ROWS, tell: list | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``asked`` (a condition on
    ``vec_id``) names, the k nearest found among all other rows, by cosine. ``tell``
    gets (flips, queries, rows probed) of each step.

    Defined cases: vectors that are null, empty, all zero, or hold null or
    non-finite components take no part, nor do rows without an id; vectors are compared
    with those of their length. Every row is a candidate and may be a query by itself,
    rows that share an id or a vector too; only a query's own row is no candidate of it.
    Ties go to the smaller vec_id. With fewer than k candidates all are returned;
    empty tables give no rows. Other columns are not read, whatever their names."""
    spark = vectors.sparkSession
    rows, wanted = usable(vectors, id_col, vec_col), F.coalesce(F.expr(asked), F.lit(False))
    entries = stored(distinct_vectors(rows, wanted, k), "ann-vectors")
    n_by_size = {r["d"]: r["count"] for r in entries.groupBy("d").count().collect()}
    n = sum(n_by_size.values())
    share = min(1.0, SAMPLE / max(1, n))
    picked = entries.filter(F.pmod(F.xxhash64("vec"), F.lit(1 << 40)) < int(share * (1 << 40))).select("d", "vec").toPandas()
    models = {}
    for d in n_by_size:
        part = sorted(picked["vec"][picked["d"] == d].map(tuple))
        models[d] = learn_rotations(np.array(part, dtype=float).reshape(-1, d))
    coded = stored(_coded(entries, models), "ann-codes")
    index = Index(coded, n, cell_rows)
    queries = coded.filter("asked").select("d", "uid", "code", cut_of(F.lit(reach(0, index.size, index.m))).alias("cut"), F.lit(-1).alias("before"))
    own = coded.filter("asked").select(F.col("uid").alias("query"), "uid")
    best = stored(_best(_scored(own, coded), k), "ann-best")
    low = -1
    for high in [*(t for t in range(STEPS) if t < index.size), index.size]:
        found = stored(index.retrieve(queries, low, high), "ann-pairs")
        if tell is not None:
            tell.append((high, queries.count(), found.filter("query IS NULL").agg(F.sum("uid")).first()[0] or 0))
        best = stored(_best(best.unionByName(_scored(found.filter("query IS NOT NULL"), coded), allowMissingColumns=True), k), "ann-best")
        if high == index.size:
            break
        # Beyond what the next step reaches, and beyond the k-th best so far, no row is of interest.
        off = F.acos(F.greatest(F.least("score", F.lit(1.0)), F.lit(-1.0))) / math.pi
        last = best.filter(F.col("place") == k + 1).select(F.col("query").alias("uid"), "score", cut_of(off).alias("nearer"))
        last_is_next = high + 1 >= min(STEPS, index.size)  # which takes whatever is left
        next_reach = F.lit(reach(high + 1, index.size, index.m))
        wider = F.lit(BITS) if last_is_next else F.greatest("cut", F.least("nearer", cut_of(next_reach)))
        queries = stored(queries.join(last, "uid", "left")
                         .filter(F.col("score").isNull() | (F.col("score") < least_cosine(high, index.size, index.m)))
                         .select("d", "uid", "code", wider.cast("int").alias("cut"), F.col("cut").alias("before")), "ann-open")
        if queries.isEmpty():
            break
        low = high
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))  # k + 1 each
    answers = lists.join(coded.select(F.col("uid").alias("query"), "vec"), "query").select("vec", "found")
    asks = rows.filter(wanted).withColumnRenamed("vec_id", "query_id").join(answers, "vec")
    # the first entry with the query's id and a cosine of its own is its own row; without it the k first are left
    itself = F.coalesce(F.get(F.filter("found", lambda x: (x["vec_id"] == F.col("query_id")) & (x["score"] > 1 - 1e-12)), F.lit(0))["place"], F.lit(k + 1))
    others = F.slice(F.filter("found", lambda x: x["place"] != itself), 1, k)
    ranked = F.transform(others, lambda x, i: F.struct((i + 1).cast("int").alias("rank"), x["vec_id"].alias("vec_id"), x["score"].alias("score")))
    return asks.select("query_id", F.explode(ranked).alias("r")).select("query_id", "r.rank", "r.vec_id", "r.score")
