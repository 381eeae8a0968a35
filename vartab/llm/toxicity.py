"""Toxicity by a weighted lexicon (operator 9).

Texts are folded (lower case, homoglyphs, digit and sign substitutions inside
words), the lexicon is matched as whole words by an Aho-Corasick automaton, and
matches inside an exception phrase don't count. The weight of a document is the
sum of the weights of its matches; that sum and the sum per hundred words give
the score through a logistic curve.

Entries of the lexicon are words, or stems (``idio*``) that match the words they
begin, as toxic words of inflected languages come in many forms.

The lexicon starts from a few general words and the curve from a prior; both learn
from labelled rows only, from a bounded sample of them: the ``SAMPLE`` training ids
with the smallest hash. Few labels change little, many decide. Words and stems are
counted in Spark, first over the toxic texts, then those frequent there over the
others; the driver gets the counts of entries that ``LEAST_SHARE`` of the toxic texts
hold (so at most 1 / LEAST_SHARE times the mean number of entries in one) and one row per
sampled id. An id counts once per entry, however many rows or texts it has. Of entries
that contain one another the one that tells most stays.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
STEMS = range(3, 9)  # lengths
THRESHOLD = 0.3
SLICE = 500
# An entry is in this share of the toxic sample (and in three texts) at least, this
# many times (log) as frequent there as elsewhere, and tells this much (in nats, over
# the sample) about the labels.
LEAST_SHARE, LEAST_LOG_ODDS, LEAST_GAIN = 0.01, 1.8, 10.0
# The general words, each as if seen in this many toxic texts and no other; the curve
# that holds without any label, and how many texts' worth of it.
PRIOR_TEXTS, PRIOR_CURVE, PRIOR_RIDGE = 2, (-4.0, 1.0, 1.0), 1.0
DEFAULT_WORDS = ("idiot", "moron", "stupid", "loser", "scum", "pathetic", "worthless", "disgusting", "trash", "clown")
EXCEPTIONS = ("trash can", "trash bin", "white trash bag", "clown fish", "circus clown", "pond scum", "sore loser board",
              "idiot light", "idiot proof", "not stupid", "not an idiot", "not a moron", "not a loser", "not worthless")
# Look-alikes of Latin letters (Cyrillic, Greek), each to its letter.
HOMOGLYPHS = dict(zip("авсԁеԍһіјкӏмпорԛѕтиѵԝхуαβεηικνορτυχωѐё", "abcdeghijklmnopqstuvwxyabenikvoptuxwee", strict=True))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_FOLD = str.maketrans(HOMOGLYPHS)
_SUBST = str.maketrans(SUBSTITUTES)
_MIXED = re.compile(r"(?<![\w@$])(?=[\d@$]*[^\W\d_])[^\W_@$]*[\d@$][\w@$]*")
_WORD = re.compile(r"[^\W_]+")


def fold_words(text: str | None) -> list[str]:
    """The words of a text as the lexicon sees them."""
    t = (text or "").lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t).translate(_FOLD)
    if _MIXED.search(t):
        t = _MIXED.sub(lambda m: m[0].translate(_SUBST), t)
    return _WORD.findall(t)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Matcher:
    """Whole-word lexicon matches outside of exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.weights = weights
        self.machine = ahocorasick.Automaton()
        for phrase in exceptions:
            self.machine.add_word(f" {phrase} ", (phrase, True))
        for word in weights:
            key = f" {word[:-1]}" if word.endswith("*") else f" {word} "
            self.machine.add_word(key, (word, False))
        self.machine.make_automaton()

    def measure(self, text: str | None) -> tuple[float, int, int]:
        """(sum of weights, matches, words)."""
        words = fold_words(text)
        found, excused = [], []
        for end, (key, exception) in self.machine.iter(f" {' '.join(words)} "):
            (excused if exception else found).append((end - len(key), end, key))
        if excused:
            found = [f for f in found if not any(a <= f[0] and f[1] <= b for a, b, _ in excused)]
        return float(sum(self.weights[k] for *_, k in found)), len(found), len(words)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``SLICE`` rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE):
            yield batch.slice(a, SLICE)


class Scorer:
    """Lexicon, exceptions and curve together."""

    def __init__(self, weights: dict[str, float], curve: np.ndarray, exceptions: tuple[str, ...] = EXCEPTIONS):
        self.matcher, self.curve = Matcher(weights, exceptions), curve

    def measure(self, texts: list[str | None]) -> tuple[np.ndarray, list[int], list[int]]:
        """(scores, matches, words) of some texts."""
        got = [self.matcher.measure(t) for t in texts]
        total, matches, words = zip(*got, strict=True) if got else ((), (), ())
        line = features(np.array(total, float), np.array(words, float)) @ self.curve
        return 1 / (1 + np.exp(-np.clip(line, -50, 50))), list(matches), list(words)


def features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Intercept, damped weight sum, and weight per hundred words."""
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(100.0 * total / np.maximum(words, 1))], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = PRIOR_RIDGE, prior: tuple = PRIOR_CURVE) -> np.ndarray:
    """Logistic regression by Newton steps, with a ridge toward ``prior``."""
    start = np.array(prior[:x.shape[1]], float)
    beta, pen = start.copy(), ridge * np.eye(len(start))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pen, x.T @ (y - p) - pen @ (beta - start))
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def entries_of(text: str | None) -> set[str]:
    """The words of a text and the stems they begin with."""
    words = set(fold_words(text))
    return words.union(w[:n] + "*" for w in words for n in STEMS if n < len(w))


def _count(rows: DataFrame, among: set[str] | None = None) -> DataFrame:
    """(entry, n): ids that hold an entry. Those of one row are summed over each task
    before the shuffle, the others meet by entry and id."""
    shared = rows.sparkSession.sparkContext.broadcast(among)  # entries of LEAST_SHARE of the toxic texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in _sliced(batches):
            kind, pairs = batch["doc_id"].type, set()
            for i, alone, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "alone", "text")), strict=True):
                found = entries_of(text)
                found = found if shared.value is None else found & shared.value
                if alone:
                    seen.update(found)
                else:
                    pairs.update((e, i) for e in found)
            if pairs:
                yield pa.RecordBatch.from_pydict({"entry": pa.array([e for e, _ in pairs], pa.string()),
                                                  "doc_id": pa.array([i for _, i in pairs], kind),
                                                  "n": pa.array([1] * len(pairs), pa.int64())})
        keys = list(seen)
        for i in range(0, len(keys), 50_000):
            part = keys[i:i + 50_000]
            yield pa.RecordBatch.from_pydict({"entry": pa.array(part, pa.string()), "doc_id": pa.nulls(len(part), kind),
                                              "n": pa.array([seen[k] for k in part], pa.int64())})

    counts = rows.select("doc_id", "alone", "text").mapInArrow(run, f"entry string, doc_id {dict(rows.dtypes)['doc_id']}, n long")
    by_id = counts.groupBy("entry", "doc_id").agg(F.sum("n").alias("n"))
    return by_id.groupBy("entry").agg(F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(1)).alias("n"))


def choose(tox: dict[str, int], rest: dict[str, int], n_tox: int, n_rest: int,
           general: tuple[str, ...] = DEFAULT_WORDS) -> dict[str, float]:
    """Weights (log odds) of the entries that tell most about the labels, and of the
    ``general`` words; none contains another."""
    total, ranked = n_tox + n_rest, []
    for entry in {**tox, **dict.fromkeys(general, 0)}:
        prior = PRIOR_TEXTS if entry in general else 0
        t, n = tox.get(entry, 0), rest.get(entry, 0)
        odds = math.log((t + prior + 0.5) / (n_tox + prior + 1)) - math.log((n + 2) / (n_rest + 2))
        if not total and prior:  # nothing to compare with
            odds = 4.0
        gain = sum(c * math.log(c * total / (label * side)) for c, label, side in (
            (t, n_tox, t + n), (n, n_rest, t + n), (n_tox - t, n_tox, total - t - n), (n_rest - n, n_rest, total - t - n))
            if c > 0)
        if odds >= LEAST_LOG_ODDS and (gain >= LEAST_GAIN or prior):
            ranked.append((-round(gain, 6), entry.endswith("*"), -len(entry), entry, odds))
    chosen: dict[str, float] = {}
    begun: set[str] = set()  # how the chosen ones begin
    for _, is_stem, _, entry, odds in sorted(ranked):
        bare = entry.rstrip("*")
        starts = [bare[:n] for n in STEMS if n <= len(bare)]
        if not any(f"{s}*" in chosen for s in starts) and not (is_stem and bare in begun):
            chosen[entry] = odds
            begun.update(starts)
    return chosen


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """Labelled training rows (doc_id, toxic, alone, text) of at most ``size`` ids, each
    text of an id once; ``alone``: the id has one row in the table."""
    ids = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    texts = docs.select("doc_id", "text")
    times = (texts.select("doc_id").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic")
             .agg((F.count(F.lit(1)) == 1).alias("alone")))
    if times.filter("NOT alone").isEmpty():  # saves the shuffles
        return texts.join(F.broadcast(ids.withColumn("alone", F.lit(True))), "doc_id")
    return texts.join(F.broadcast(times), "doc_id").dropDuplicates()


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[dict[str, float], np.ndarray]:
    """(lexicon weights, curve) from the training sample."""
    rows = sample(docs, labels, size)
    classes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()}
    n_tox, n_rest = classes.get(1, 0), classes.get(0, 0)
    least = max(3, LEAST_SHARE * n_tox)
    general = F.col("entry").isin(*DEFAULT_WORDS)
    tox = {r["entry"]: r["n"] for r in _count(rows.filter("toxic = 1")).filter((F.col("n") >= least) | general).collect()}
    rest = {r["entry"]: r["n"] for r in _count(rows.filter("toxic = 0"), {*tox, *DEFAULT_WORDS}).collect()}
    weights = choose(tox, rest, n_tox, n_rest)
    seen = (_measured(rows, weights, ["doc_id", "toxic"]).groupBy("doc_id")
            .agg(F.max("toxic").alias("toxic"), F.max("total").alias("total"), F.min("words").alias("words")).toPandas())
    seen = seen.sort_values("doc_id")
    curve = fit_curve(features(seen["total"].to_numpy(float), seen["words"].to_numpy(float)), seen["toxic"].to_numpy(float))
    return weights, curve


def _measured(rows: DataFrame, weights: dict[str, float], keep: list[str],
              exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    names = [*keep, "total", "matches", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(weights, exceptions)
        for batch in _sliced(batches):
            got = [matcher.measure(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in keep] + [pa.array([g[i] for g in got], kind) for i, kind in
                                            enumerate((pa.float64(), pa.int64(), pa.int64()))], names)

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["total double", "matches long", "words long"])
    return rows.select(*keep, "text").mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (and matches, words) of every row.

    Defined cases: a null text scores as an empty one, which gets the score of a
    text without matches; rows with a null id are scored and not held out; rows
    that share an id are scored one by one; labels that are null, or without an
    id, teach nothing, and the larger of several labels of an id holds; an id
    with several rows teaches once, by the words of all its texts; without
    labels the general words and the prior curve hold; an empty
    table gives no rows. Other columns are not read."""
    weights, curve = learn(docs, labels, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, curve)
        for batch in _sliced(batches):
            scores, matches, words = scorer.measure(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(scores, pa.float64()), pa.array(scores >= threshold, pa.bool_()).cast(pa.int32()),
                 pa.array(matches, pa.int64()), pa.array(words, pa.int64())],
                ["doc_id", "score", "predicted", "matches", "words"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int, matches long, words long")
    return rows.select("doc_id", held_out().alias("held_out"), "score", "predicted", "matches", "words")


def keep_clean(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``score`` puts below the threshold, with all
    their columns; cases as there."""
    weights, curve = learn(docs, labels, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, curve)
        for batch in _sliced(batches):
            scores, _, _ = scorer.measure(batch["text"].to_pylist())
            yield batch.filter(pa.array(scores < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
