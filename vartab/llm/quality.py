"""Quality of documents by a factorisation machine (operator 11).

Inputs of the machine are hashed words (damped counts, a unit vector per text),
statistics of a text's structure, each as a standardised value and as one of a few
bins, and metadata columns likewise. Besides a weight every input has ``RANK``
factors, and the score adds the dot products of the factors of every pair of
inputs; by (sum of squares identity)

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

that takes time in proportion to the inputs present, not to their pairs.

The machine is fitted by mini-batch gradient steps on a bounded sample of labelled
rows: the ``SAMPLE`` training ids with the smallest hash. Their inputs are made in
Spark; the driver gets at most ``SAMPLE`` x ``BUCKETS`` of them. Scoring is one pass
over whole texts with the machine (``BUCKETS`` x (``RANK`` + 1) floats) in every task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vartab.llm.words import hash_words

SAMPLE = 8_000
BUCKETS = 1 << 14
RANK = 8
BINS = (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)  # quantiles of the sample between them
THRESHOLD = 0.3
SLICE_BYTES = 4 << 20
EPOCHS, BATCH, RATE = 25, 256, 0.02
DECAY_WORDS, DECAY_OTHERS = 2e-3, 1e-4

# Bytes by what they tell of a text's structure.
_CLASSES = ("lower", "upper", "digit", "blank", "newline", "beyond", "stop", "bang", "bar", "sign")
_CLASS = np.full(256, _CLASSES.index("sign"), np.uint8)
for _name, _bytes in (("lower", range(0x61, 0x7B)), ("upper", range(0x41, 0x5B)), ("digit", range(0x30, 0x3A)),
                      ("blank", b" \t\r\v\f"), ("newline", b"\n"), ("beyond", range(0x80, 0x100)),
                      ("stop", b".,;:'\"()-"), ("bang", b"!?"), ("bar", b"|")):
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
_COUNTED = len(_CLASSES) + 3  # and words, repeated words, repeated signs
STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "digits", "newlines", "beyond", "stops", "bangs", "bars",
              "signs", "repeated_words", "repeated_signs", "distinct")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


# --- inputs of texts -----------------------------------------------------------------------------------------------

def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """(numbers, texts) of slices of about ``SLICE_BYTES``; a longer text comes in
    several, cut after a space."""
    numbers, held, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at == 0 or at < len(text):
            end = len(text) if len(text) - at <= SLICE_BYTES else text.rfind(b" ", at, at + SLICE_BYTES) + 1
            if end <= at:  # one word longer than a slice
                end = text.find(b" ", at) + 1 or len(text)
            if held and size + end - at > SLICE_BYTES:
                yield numbers, held
                numbers, held, size = [], [], 0
            numbers.append(i)
            held.append(text[at:end])
            size += end - at
            at = end or 1
    if held:
        yield numbers, held


def _structure(texts: list[bytes], hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Counts that add up over the parts of a text: bytes of each class, words, words
    and signs that repeat the one before."""
    out = np.zeros((len(texts), _COUNTED))
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    kind = _CLASS[data]
    at = np.cumsum(sizes) - sizes
    for k in range(len(_CLASSES)):
        out[:, k] = np.add.reduceat(kind == k, at, dtype=np.int64)
    out[:, _CLASSES.index("blank")] -= 1  # the one between texts
    out[:, -3] = np.diff(first)
    again = np.concatenate([[0], np.cumsum(hashes[1:] == hashes[:-1])]) if len(hashes) else np.zeros(1)
    some = out[:, -3] > 0
    out[some, -2] = again[first[1:][some] - 1] - again[first[:-1][some]]
    twice = np.zeros(len(data), bool)
    twice[1:] = (data[1:] == data[:-1]) & (kind[1:] >= _CLASSES.index("stop"))
    out[:, -1] = np.add.reduceat(twice, at, dtype=np.int64)
    return out


def inputs_of(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, value) of the hashed words, by text, and the statistics."""
    keys, counts, structure = [], [], np.zeros((len(texts), _COUNTED))
    for numbers, part in _parts(texts):
        words = hash_words(part)
        owner = np.repeat(np.array(numbers, dtype=np.int64), words.counts())
        key, n = np.unique(owner * buckets + (words.hashes % np.uint64(buckets)).astype(np.int64), return_counts=True)
        keys.append(key)
        counts.append(n)
        np.add.at(structure, numbers, _structure(part, words.hashes, words.first))
    key, at = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate(counts) if counts else None, minlength=len(key))
    owner, bucket, value = key // buckets, key % buckets, np.log1p(count)
    norm = np.sqrt(np.bincount(owner, weights=value * value, minlength=len(texts)))
    of = dict(zip(_CLASSES, structure.T, strict=False))
    words, size = structure[:, -3], structure[:, :len(_CLASSES)].sum(1)
    letters = np.maximum(of["lower"] + of["upper"] + of["beyond"], 1)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    held = np.bincount(owner, minlength=len(texts))
    stats = np.stack([np.log1p(size), np.log1p(words), (size - of["blank"] - of["newline"]) / per_word, of["upper"] / letters,
                      of["digit"] / per_byte, of["newline"] / per_word, of["beyond"] / letters, of["stop"] / per_word,
                      of["bang"] / per_word, of["bar"] / per_word, of["sign"] / per_word, structure[:, -2] / per_word,
                      structure[:, -1] / per_word, held / np.maximum(np.minimum(words, buckets), 1)], axis=1)
    return owner, bucket, value / norm[owner], stats


# --- the machine ---------------------------------------------------------------------------------------------------

@dataclass
class Machine:
    """Weights and factors of all inputs, and how numbers become inputs."""

    bias: float
    weights: np.ndarray      # buckets, numbers, missing numbers, bins
    factors: np.ndarray      # the same by RANK
    mean: np.ndarray
    spread: np.ndarray
    edges: list[np.ndarray]  # of the bins of each number
    buckets: int

    def rows(self, owner: np.ndarray, bucket: np.ndarray, value: np.ndarray, numbers: np.ndarray) -> tuple:
        """(text number, input, value) of everything present, in order of texts."""
        n, d = numbers.shape
        known = ~np.isnan(numbers)
        scaled = np.clip((np.where(known, numbers, 0) - self.mean) / self.spread, -3, 3) / 3
        base, wide = self.buckets + np.arange(d), len(BINS) + 1
        bins = np.stack([np.searchsorted(e, numbers[:, j]) for j, e in enumerate(self.edges)], axis=1)
        which = np.where(known, base, base + d)
        column = np.where(known, self.buckets + 2 * d + np.arange(d) * wide + bins, which)
        texts = np.repeat(np.arange(n), d)
        number = np.where(known, scaled, 0.5).ravel()
        at = np.concatenate([owner, texts, texts[known.ravel()]])
        order = np.argsort(at, kind="stable")
        index = np.concatenate([bucket, which.ravel(), column[known]])
        values = np.concatenate([value, number, np.full(int(known.sum()), 0.5)])
        return at[order], index[order], values[order]

    def raw(self, n: int, at: np.ndarray, index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score on the logit scale, sums of the factors) of n texts, in linear time."""
        line = self.bias + np.bincount(at, weights=self.weights[index] * values, minlength=n)
        sums = np.empty((n, self.factors.shape[1]))
        for f in range(sums.shape[1]):
            part = self.factors[index, f] * values
            sums[:, f] = np.bincount(at, weights=part, minlength=n)
            line += (sums[:, f] ** 2 - np.bincount(at, weights=part * part, minlength=n)) / 2
        return line, sums

    def scores(self, texts: list[bytes], metadata: np.ndarray) -> np.ndarray:
        owner, bucket, value, stats = inputs_of(texts, self.buckets)
        line, _ = self.raw(len(texts), *self.rows(owner, bucket, value, np.concatenate([stats, metadata], axis=1)))
        return sigmoid(line)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_machine(bags: list[tuple[np.ndarray, np.ndarray]], numbers: np.ndarray, label: np.ndarray, buckets: int = BUCKETS,
                rank: int = RANK, epochs: int = EPOCHS, seed: int = 13) -> Machine:
    """A machine for texts given as (buckets, values) and numbers (NaN: missing), with
    labels 0 and 1, by Adam steps on the logistic loss with decay."""
    rng, d = np.random.default_rng(seed), numbers.shape[1]
    known = [numbers[~np.isnan(numbers[:, j]), j] for j in range(d)]
    mean = np.array([k.mean() if len(k) else 0.0 for k in known])
    spread = np.array([max(k.std(), 1e-6) if len(k) else 1.0 for k in known])
    edges = [np.unique(np.quantile(k, BINS)) if len(k) else np.empty(0) for k in known]
    size, n = buckets + d * (3 + len(BINS)), len(label)
    share = (label.sum() + 1) / (n + 2)
    start = rng.normal(0, 0.02 if n else 0, (size, rank))  # without rows nothing would ever move it
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size), start, mean, spread, edges, buckets)
    decay = np.where(np.arange(size) < buckets, DECAY_WORDS, DECAY_OTHERS)
    params = np.concatenate([m.weights[:, None], m.factors], axis=1)
    first, second, step = np.zeros_like(params), np.zeros_like(params), 0
    for epoch in range(epochs):
        order, rate = rng.permutation(n), RATE * (1 - epoch / epochs)
        for a in range(0, n, BATCH):
            some = order[a:a + BATCH]
            k = len(some)
            owner = np.repeat(np.arange(k), [len(bags[i][0]) for i in some])
            at, index, values = m.rows(owner, np.concatenate([bags[i][0] for i in some]).astype(np.int64),
                                       np.concatenate([bags[i][1] for i in some]).astype(float), numbers[some])
            line, sums = m.raw(k, at, index, values)
            off = (sigmoid(line) - label[some]) / k
            pull = off[at] * values
            slope = decay[:, None] * params
            slope[:, 0] += np.bincount(index, weights=pull, minlength=size)
            for f in range(rank):
                slope[:, f + 1] += np.bincount(index, weights=pull * (sums[at, f] - m.factors[index, f] * values), minlength=size)
            step += 1
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            params -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            m.weights, m.factors = params[:, 0].copy(), params[:, 1:].copy()
            m.bias -= rate * off.sum()
    return m


# --- the operator --------------------------------------------------------------------------------------------------

def _numbers(columns: Sequence[pa.Array]) -> np.ndarray:
    """Metadata columns on a logarithmic scale, NaN where missing or negative."""
    held = [np.array(c.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float) for c in columns]
    with np.errstate(invalid="ignore"):
        return np.stack([np.log1p(np.where(np.isfinite(h) & (h >= 0), h, np.nan)) for h in held], axis=1)


def _rows(df: DataFrame, metadata: Sequence[str], *more: Column) -> DataFrame:
    return df.select(*more, F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"),
                     *[F.col(c).cast("double").alias(f"meta_{i}") for i, c in enumerate(metadata)])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about ``SLICE_BYTES`` of texts (or one row)."""
    for batch in batches:
        size = np.cumsum(np.array([len(b.as_buffer()) for b in batch["body"]], dtype=np.int64))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE_BYTES, side="right")))
            yield batch.slice(a, b - a)
            a = b


def sample(docs: DataFrame, labels: DataFrame, metadata: Sequence[str], size: int = SAMPLE) -> DataFrame:
    """(h, label, text, metadata) of at most ``size`` labelled training ids, one row an
    id: its least text, and the largest of each metadata column."""
    ids = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                      *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(metadata)])
    rows = own.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(
        F.min("text").alias("text"), *[F.max(f"_{i}").alias(c) for i, c in enumerate(metadata)])
    return rows.withColumn("h", F.xxhash64("doc_id"))


def learn(docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = ("n_chars",), size: int = SAMPLE,
          buckets: int = BUCKETS) -> Machine:
    """The machine fitted on the sample. With labels of one class only it leans to
    that class, without labels it says 0.5."""
    n_meta = len(metadata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            owner, bucket, value, stats = inputs_of(batch["body"].to_pylist(), buckets)
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            numbers = np.concatenate([stats, _numbers([batch[f"meta_{i}"] for i in range(n_meta)])], axis=1) if n_meta else stats
            yield pa.RecordBatch.from_arrays(
                [batch["h"], batch["label"], pa.array([bucket[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                 pa.array([value[a:b].astype("<f4").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                 pa.array([x.astype("<f8").tobytes() for x in numbers], pa.binary())], ["h", "label", "buckets", "value", "numbers"])

    rows = _rows(sample(docs, labels, metadata, size), metadata, F.col("h"), F.col("label"))
    got = sorted(rows.mapInArrow(run, "h long, label int, buckets binary, value binary, numbers binary").collect(),
                 key=lambda r: (r["h"], r["label"], bytes(r["buckets"])))
    bags = [(np.frombuffer(bytes(r["buckets"]), "<u4"), np.frombuffer(bytes(r["value"]), "<f4")) for r in got]
    numbers = np.array([np.frombuffer(bytes(r["numbers"]), "<f8") for r in got]).reshape(len(got), len(STATISTICS) + n_meta)
    return fit_machine(bags, numbers, np.array([float(r["label"] == 1) for r in got]), buckets)


def score(docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = ("n_chars",), size: int = SAMPLE,
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Defined cases: a null text scores as an empty one; a missing or negative
    metadata value is an input of its own; rows with a null id are scored and not
    held out; rows that share an id are scored one by one; labels that are null or
    without an id teach nothing, and the larger of several labels of an id holds; an
    id with several rows teaches once, by its least text; without labels every score
    is 0.5; an empty table gives no rows. ``labels``, ``lang``, ``source`` and the id
    are no inputs; other columns than id, text and ``metadata`` are not read."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, metadata, size))
    n_meta = len(metadata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        for batch in _slices(batches):
            meta = _numbers([batch[f"meta_{i}"] for i in range(n_meta)]) if n_meta else np.empty((batch.num_rows, 0))
            scores = machine.scores(batch["body"].to_pylist(), meta)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = _rows(docs, metadata, F.col("doc_id").cast("long").alias("doc_id"))
    return (rows.mapInArrow(run, "doc_id long, score double, predicted int")
            .select("doc_id", held_out().alias("held_out"), "score", "predicted"))
