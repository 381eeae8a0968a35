"""Benchmark decontamination by latent semantic retrieval (operator 1).

1. Fit, over all texts: words are hashed into ``DIMS`` buckets; passages of
   ``PASSAGE`` words are the rows of a TF-IDF matrix A. A randomised SVD of A
   needs A'(A W) for a random W of ``RANK`` columns, which is a sum over
   passages: every task sums its own, the sums meet by range of buckets, and
   only the DIMS x RANK result (of fixed size) reaches the driver. Bucket counts
   for the IDF come from the same pass.
2. Search, over all texts: items and overlapping windows of the texts are
   projected to the latent space (scaled by the singular values, so that what
   all passages have in common does not dominate), and pairs with a cosine of
   ``COSINE`` or more are candidates. Windows are kept as sums of eight-word
   blocks; a window is less than twice as long as the item passage it may hold,
   so that a verbatim passage has a cosine of about 0.7 or more.
   The cosine is lossy, so there is an exact route beside it. An item of m words
   of which step 3 wants k has at least two matched words among its m - k + 2
   rarest; two of these in one text within the item's span (its words and half as
   many, at least eight, others) make the words around them a candidate. This
   loses nothing that step 3 accepts within a span, at any length and order.
3. Candidates whose shared words carry half of the item passage's weight get a
   longest common subsequence of item and surrounding text. An item is found if
   it covers ``EXACT`` of the item's words, or ``PARAPHRASE`` of them and the
   same share of its answer, the last quarter of the item.

Items are the small side: they travel to the tasks in passes of at most
``ITEMS_PER_PASS``, one scan of the texts each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.llm.jaccard import plain
from vartab.llm.words import Words, hash_words

DIMS, RANK = 8192, 64
PASSAGE = 48
BLOCK = 8
# (longest item passage, window in blocks, stride in blocks)
SCALES = ((16, 3, 1), (24, 4, 1), (32, 6, 2))
COSINE, OVERLAP = 0.4, 0.5
EXACT, PARAPHRASE = 0.8, 0.6
LEAST_GAP, GAP_SHARE = 8, 0.5  # foreign words in an item's span
REGIONS = 4096  # looked at together
LEAST_WORDS = 5
ITEMS_PER_PASS = 5000
SLICE_BYTES = 4 << 20
RANGES, SALTS = 8, 16
RESULT = "doc_id long, item_id long, cosine double, lcs double, answer double"


def buckets_of(words: Words) -> np.ndarray:
    return (words.hashes >> np.uint64(64 - 13)).astype(np.int32)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, size = [], [], 0
    for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
        if texts and size + len(t or "") > SLICE_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(plain(t))
        size += len(texts[-1])
    if texts:
        yield ids, texts


def _cut(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``size`` words (the last of a text may be shorter),
    and the number of the first run of each text."""
    runs = -(-words.counts() // size)
    first = np.concatenate([[0], np.cumsum(runs)])
    within = np.arange(first[-1]) - np.repeat(first[:-1], runs)
    return np.repeat(words.first[:-1], runs) + within * size, first


def _run_sums(rows: np.ndarray, picks: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows[picks[a:b]] for runs of at most ``size`` picks; the last row
    of ``rows`` is zero and fills up shorter runs."""
    out = np.zeros((len(starts), rows.shape[1]), rows.dtype)
    zero, top = len(rows) - 1, len(picks) - 1
    for i in range(size):
        at = starts + i
        out += rows[np.where(at < stops, picks[np.minimum(at, top)], zero)]
    return out


def _with_zero(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])


def random_columns() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((DIMS, RANK)).astype(np.float32)


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """T'(T W) and passage counts of the task's passages, T their word counts."""
    w = _with_zero(random_columns())
    total, seen, passages = np.zeros((DIMS, RANK), np.float32), np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for _, texts in _slices(batch):
            words = hash_words(texts)
            idx = buckets_of(words)
            if not len(idx):
                continue
            starts, _ = _cut(words, PASSAGE)
            stops = np.append(starts[1:], len(idx))
            z = _with_zero(_run_sums(w, idx, starts, stops, PASSAGE))
            owner = np.repeat(np.arange(len(starts), dtype=np.int32), stops - starts)
            order = np.argsort(idx.astype(np.uint16), kind="stable")
            owner, bucket = owner[order], idx[order]
            # the passages of a bucket in runs of eight, then the runs of a bucket
            opens = np.flatnonzero(np.diff(bucket, prepend=-1))
            sizes = np.diff(np.append(opens, len(bucket)))
            runs = -(-sizes // 8)
            first = np.cumsum(runs) - runs
            begin = np.repeat(opens, runs) + 8 * (np.arange(runs.sum()) - np.repeat(first, runs))
            sums = _run_sums(z, owner, begin, np.repeat(opens + sizes, runs), 8)
            total[bucket[opens]] += np.add.reduceat(sums, first, axis=0)
            # a bucket counts once a passage: owners ascend within a bucket
            again = np.zeros(len(bucket), bool)
            again[1:] = (bucket[1:] == bucket[:-1]) & (owner[1:] == owner[:-1])
            seen += np.bincount(bucket[~again], minlength=DIMS)
            passages += len(starts)
    if passages:
        step = DIMS // RANGES
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(range(RANGES), pa.int32()), "salt": pa.array([salt] * RANGES, pa.int32()),
            "sums": pa.array([_pack(total[r * step:(r + 1) * step]) for r in range(RANGES)], pa.binary()),
            "seen": pa.array([seen[r * step:(r + 1) * step].tobytes() for r in range(RANGES)], pa.binary()),
            "passages": pa.array([passages] * RANGES, pa.int64())})


def _pack(x: np.ndarray) -> bytes:
    """Half precision with a common scale: the sketch of a range needs no more."""
    scale = np.float64(max(np.abs(x).max(), 1e-30) / 60000)
    return scale.tobytes() + (x / scale).astype(np.float16).tobytes()


def _unpack(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.float16, offset=8).astype(np.float64).reshape(-1, RANK) * np.frombuffer(body, np.float64, 1)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up what a task is given by range of buckets, row after row."""
    held: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            sums, seen = _unpack(row["sums"]), np.frombuffer(row["seen"], np.int64)
            if row["part"] in held:
                h = held[row["part"]]
                h[0], h[1], h[2] = h[0] + sums, h[1] + seen, h[2] + row["passages"]
            else:
                held[row["part"]] = [sums, seen, row["passages"]]
    for part, (sums, seen, passages) in held.items():
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "salt": pa.array([0], pa.int32()), "sums": pa.array([_pack(sums)], pa.binary()),
            "seen": pa.array([seen.tobytes()], pa.binary()), "passages": pa.array([passages], pa.int64())})


def fit(texts: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """(map from buckets to the scaled latent space, IDF included; IDF), float32,
    with a zero row at the end; None without any word."""
    schema = "part int, salt int, sums binary, seen binary, passages long"
    rows = texts.mapInArrow(_sum_task, schema)
    # two levels, so that many tasks' sums don't meet in few; both only stream
    some = rows.repartition(RANGES * SALTS, "part", "salt").mapInArrow(_add, schema)
    parts = some.repartition(RANGES, "part").mapInArrow(_add, schema).collect()  # RANGES rows
    if not parts:
        return None
    parts.sort(key=lambda r: r["part"])
    sums = np.concatenate([_unpack(r["sums"]) for r in parts])
    seen = np.concatenate([np.frombuffer(r["seen"], np.int64) for r in parts])
    idf = np.log(max(parts[0]["passages"], 2) / np.maximum(seen, 1)).clip(0)
    u, s, _ = np.linalg.svd(idf[:, None] * sums, full_matrices=False)  # squares of the singular values of A
    scale = np.where(s > s[0] * 1e-6, 1 / np.sqrt(np.maximum(s, 1e-12)), 0)
    return _with_zero((idf[:, None] * u * scale).astype(np.float32)), idf.astype(np.float32)


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by words of bits."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & masks.get(x, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


class Rare:
    """What the exact route needs of one item; words are numbers in the vocabulary of the pass."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, latent: np.ndarray):
        size = len(words)
        self.words, at, self.times = np.unique(words, return_index=True, return_counts=True)
        self.weights = weights[at]
        self.least = next(k for k in range(size + 1) if k / size >= PARAPHRASE)
        self.span = size + max(LEAST_GAP, int(size * GAP_SHARE))
        self.anchors = np.unique(words[np.argsort(-weights, kind="stable")[:size - self.least + 2]])
        norm = np.linalg.norm(latent)
        self.vector = latent / norm if norm > 0 else latent


class Items:
    """Items of one pass: their words, the latent vectors of their passages by
    scale, and their rarest words."""

    def __init__(self, items: list[tuple[int, bytes]], space: tuple[np.ndarray, np.ndarray]):
        latent, idf = space
        words = hash_words([t for _, t in items])
        counts = words.counts()
        keep = [i for i in range(len(items)) if counts[i] >= LEAST_WORDS]
        self.ids = [items[i][0] for i in keep]
        self.words = [words.hashes[words.first[i]:words.first[i + 1]].tolist() for i in keep]
        idx = buckets_of(words)
        self.vocabulary = np.unique(np.concatenate([np.array(w, np.uint64) for w in self.words] or [np.empty(0, np.uint64)]))
        self.rare = []
        for n, i in enumerate(keep):
            b = idx[words.first[i]:words.first[i + 1]]
            at = np.searchsorted(self.vocabulary, np.array(self.words[n], np.uint64))
            self.rare.append(Rare(at, idf[b], latent[b].sum(0)))
        self.is_anchor = np.zeros(len(self.vocabulary) + 1, bool)
        for r in self.rare:
            self.is_anchor[r.anchors] = True
        self.scales = []
        for k, (longest, blocks, stride) in enumerate(SCALES):
            owner, offset, vectors, weights = [], [], [], []
            for n, i in enumerate(keep):
                size = len(self.words[n])
                if k != next((j for j, c in enumerate(SCALES) if size <= c[0]), len(SCALES) - 1):
                    continue
                starts = [0] if size <= longest else [*range(0, size - longest, longest), size - longest]
                for a in starts:
                    b = idx[words.first[i] + a:words.first[i] + min(a + longest, size)]
                    z = latent[b].sum(0)
                    norm = np.linalg.norm(z)
                    if norm > 0:
                        own = np.zeros(DIMS + 1, np.float32)  # what the passage's words weigh
                        own[b] = idf[b]
                        owner.append(n)
                        offset.append(a)
                        vectors.append(z / norm)
                        weights.append((own, float(own.sum())))
            self.scales.append((blocks, stride, owner, offset, np.array(vectors, np.float32).reshape(-1, RANK), weights))


def _judge(items: Items, item: int, region: list[int]) -> tuple[float, float] | None:
    """(lcs, answer) if the item is found in the words of ``region``."""
    size = len(items.words[item])
    tail = max(3, size // 4)
    whole = lcs(items.words[item], region) / size
    answer = lcs(items.words[item][-tail:], region) / tail
    return (whole, answer) if whole >= EXACT or (whole >= PARAPHRASE and answer >= PARAPHRASE) else None


def _rare_regions(words: Words, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, start, stop) of the regions of the exact route."""
    vocabulary, missing = items.vocabulary, len(items.vocabulary)
    number = np.searchsorted(vocabulary, words.hashes)
    number[vocabulary[np.minimum(number, missing - 1)] != words.hashes] = missing
    spots = np.flatnonzero(items.is_anchor[number])
    spots = spots[np.argsort(number[spots], kind="stable")]
    cuts = np.searchsorted(number[spots], np.arange(missing + 1))
    local = np.zeros(missing + 1, np.int16)  # of the item at hand: 1, 2, ... for its words
    for item, rare in enumerate(items.rare):
        at = np.sort(np.concatenate([spots[cuts[v]:cuts[v + 1]] for v in rare.anchors]))
        near = np.flatnonzero(np.diff(at) < rare.span)
        text = np.searchsorted(words.first, at[near], side="right") - 1
        same = at[near + 1] < words.first[text + 1]
        near, text = near[same], text[same]
        if not len(near):
            continue
        local[rare.words] = np.arange(1, len(rare.words) + 1)
        starts = np.maximum(words.first[text], at[near + 1] - rare.span + 1)
        stops = np.minimum(words.first[text + 1], at[near] + rare.span)
        for a in range(0, len(near), REGIONS):
            lo, hi = starts[a:a + REGIONS, None], stops[a:a + REGIONS, None]
            spread = lo + np.arange(2 * rare.span)
            held = np.where(spread < hi, local[number[np.minimum(spread, len(number) - 1)]], 0)
            there = np.zeros((len(lo), len(rare.words) + 1), bool)
            there[np.arange(len(lo))[:, None], held] = True
            there = there[:, 1:]
            good = (there @ rare.times >= rare.least) & (there @ rare.weights >= OVERLAP * rare.weights.sum() * (1 - 1e-5))
            for j in (a + np.flatnonzero(good)).tolist():
                yield int(text[j]), item, int(starts[j]), int(stops[j])
        local[rare.words] = 0


def search_texts(texts: list[bytes], items: Items, latent: np.ndarray) -> list[tuple[int, int, float, float, float]]:
    """(text, item, cosine, lcs, answer) of the items found, the best window each."""
    words = hash_words(texts)
    idx = buckets_of(words)
    if not len(idx) or not items.ids:
        return []
    starts, first = _cut(words, BLOCK)
    ends = np.repeat(words.first[1:], np.diff(first))  # of the text a block is in
    sums = _with_zero(_run_sums(latent, idx, starts, ends, BLOCK))
    buckets = np.full((len(starts) + 1, BLOCK), DIMS, np.int16)  # DIMS: no word
    for i in range(BLOCK):
        there = starts + i < ends
        buckets[:-1][there, i] = idx[starts[there] + i]
    last = np.repeat(first[1:], np.diff(first))
    number = np.arange(len(starts)) - np.repeat(first[:-1], np.diff(first))
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for blocks, stride, owner, offset, vectors, weights in items.scales:
        if not len(vectors):
            continue
        # a window is every stride-th block of a text with the blocks after it
        win = np.flatnonzero(number % stride == 0)
        z, held = np.zeros((len(win), RANK), np.float32), np.empty((len(win), blocks, BLOCK), np.int16)
        for b in range(blocks):
            block = np.where(win + b < last[win], win + b, len(starts))
            z += sums[block]
            held[:, b] = buckets[block]
        held = held.reshape(len(win), -1)
        z /= np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-30)[:, None]
        cosine = z @ vectors.T
        at, passage = np.divmod(np.flatnonzero(cosine.ravel() >= COSINE), len(vectors))
        if not len(at):
            continue
        a = starts[win[at]]
        n = np.minimum(a + blocks * BLOCK, ends[win[at]]) - a
        order = np.argsort(passage, kind="stable")
        cuts = np.searchsorted(passage[order], np.arange(len(vectors) + 1))
        for p, (own, total) in enumerate(weights):
            mine = order[cuts[p]:cuts[p + 1]]
            if not len(mine):
                continue
            # repeated words count again here, so this drops nothing that has enough
            mine = mine[own[held[at[mine]]].sum(1) >= OVERLAP * total]
            if not len(mine):
                continue
            there = np.sort(held[at[mine]], axis=1)
            once = np.diff(there, axis=1, prepend=np.int16(-1)) != 0
            mine = mine[(own[there] * once).sum(1) >= OVERLAP * total]
            item = owner[p]
            size = len(items.words[item])
            for j in mine.tolist():
                t = int(np.searchsorted(words.first, a[j], side="right") - 1)
                lo = max(int(words.first[t]), int(a[j]) - offset[p] - 2 * BLOCK)
                hi = min(int(words.first[t + 1]), int(a[j] + n[j]) + size - offset[p] + BLOCK)
                judged = _judge(items, item, words.hashes[lo:hi].tolist())
                if judged:
                    found = (*judged, float(cosine[at[j], passage[j]]))
                    if found > best.get((t, item), (0.0, 0.0, 0.0)):
                        best[t, item] = found
    for t, item, lo, hi in _rare_regions(words, items):
        judged = _judge(items, item, words.hashes[lo:hi].tolist())
        if judged and judged > best.get((t, item), (0.0, 0.0, 0.0))[:2]:
            z = latent[idx[lo:hi]].sum(0)
            best[t, item] = (*judged, float(z @ items.rare[item].vector / max(np.linalg.norm(z), 1e-30)))
    return [(t, item, c, w, x) for (t, item), (w, x, c) in best.items()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer: the items found in each document;
    documents without any are not in the result.

    Defined cases: null or empty texts hold nothing; items that are null or of
    fewer than five words are not searched (``unsearched_items`` returns them): a few
    common words are in clean documents too; items with equal texts are found
    alike; rows that share a doc_id are reported together, the best match per
    item; rows without a doc_id are reported under null; an empty table on
    either side gives no rows. Other columns are not read, whatever their names."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], RESULT)
    for task_items in _passes(texts, benchmark, item_col, item_text, items_per_pass):
        def run(batches: Iterator[pa.RecordBatch], task_items=task_items) -> Iterator[pa.RecordBatch]:
            items, latent = task_items()
            for batch in batches:
                rows = []
                for ids, texts in _slices(batch):
                    rows += [(ids[t], items.ids[i], c, w, a) for t, i, c, w, a in search_texts(texts, items, latent)]
                cols = list(zip(*rows, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["doc_id", "item_id", "cosine", "lcs", "answer"])
        out = out.unionByName(texts.mapInArrow(run, RESULT))
    return out.groupBy("doc_id", "item_id").agg(
        F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))


def unsearched_items(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, text, n_words of the items that ``contaminated`` does not search: those
    of fewer than ``LEAST_WORDS`` words, null ones included (no words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = hash_words([plain(t) for t in batch["text"].to_pylist()]).counts()
            short = pa.array(n < LEAST_WORDS)
            yield batch.append_column("n_words", pa.array(n.astype(np.int64))).filter(short)

    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    return rows.mapInArrow(run, "item_id long, text string, n_words long")


def _passes(texts: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, items_per_pass: int) -> list:
    """Per pass, a function that gives a task its items and the latent space."""
    sc = texts.sparkSession.sparkContext
    wanted = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    passes = -(-wanted.count() // items_per_pass)
    space = fit(texts) if passes else None
    if space is None:
        return []
    shared = sc.broadcast(space)  # DIMS x (RANK + 1) floats
    out = []
    for k in range(passes):
        part = wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect()
        given = sc.broadcast([(r["item_id"], plain(r["text"])) for r in part])
        out.append(lambda given=given: (Items(given.value, shared.value), shared.value[0]))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) in which no item is
    found, with all their columns; cases as in ``contaminated``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for task_items in _passes(texts, benchmark, "item_id", "text", items_per_pass):
        def run(batches: Iterator[pa.RecordBatch], task_items=task_items) -> Iterator[pa.RecordBatch]:
            items, latent = task_items()
            for batch in batches:
                hit = np.zeros(batch.num_rows, bool)
                at = 0
                for _, texts in _slices(batch):
                    for t, *_ in search_texts(texts, items, latent):
                        hit[at + t] = True
                    at += len(texts)
                yield batch.filter(pa.array(~hit))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
