import re
import zlib

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import toxicity
from vartab.llm.common import table
from vartab.llm.queries import op9_toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("text, words", [
    ("Yоu аre an 1d10t, tr4sh! 2021 m0ron $cum p@thetic", "you are an idiot trash 2021 moron scum pathetic"),
    (None, ""), ("", ""), ("ＩＤＩＯＴ", "idiot"), ("a1 3 42", "ai 3 42"), ("snake_case", "snake case")])
def test_folding(text, words):
    assert " ".join(toxicity.fold_words(text)) == words


@pytest.mark.parametrize("text", ["x" * 300_000, "x1" * 150_000, "$" * 300_000, "1" * 300_000 + "a"])
def test_long_runs_take_no_time(text):
    assert len(toxicity.fold_words(text)) <= 1


def brute(text, weights, exceptions):
    words = toxicity.fold_words(text)
    joined = " " + " ".join(words) + " "
    excused = [(m.start(1), m.end(1)) for e in exceptions for m in re.finditer(f"(?=( {re.escape(e)} ))", joined)]
    pattern = lambda w: re.escape(w[:-1]) if w.endswith("*") else re.escape(w) + " "
    hits = [(m.start(1), m.end(1), w) for w in weights for m in re.finditer(f"(?=( {pattern(w)}))", joined)]
    hits = [w for a, b, w in hits if not any(x <= a and b <= y for x, y in excused)]
    return sum(weights[w] for w in hits), len(hits), len(words)


def test_matches_like_brute_force(spark):
    weights = {w: 1.0 + i for i, w in enumerate(toxicity.DEFAULT_WORDS)} | {"trash clown": 3.0, "trashi*": 9.0, "the*": 0.5}
    matcher = toxicity.Matcher(weights)
    texts = [r.text for r in table(spark, SF_SMALL, "documents").collect()]
    texts += ["idiot idiot idiot", "the trash can and the trash", "not an idiot, an idiot", "trash clown fish", "idiots trashy", "clown", "trashi trashing strashing"]
    for t in texts:
        assert matcher.measure(t) == pytest.approx(brute(t, weights, toxicity.EXCEPTIONS))


def test_entries_are_chosen_by_what_they_tell():
    tox = {"idiot": 60, "idio*": 60, "idi*": 61, "cass*": 30, "casso": 5, "the": 100, "rare": 3}
    rest = {"idi*": 50, "the": 900, "cass*": 4}
    chosen = toxicity.choose(tox, rest, 100, 900, general=())
    assert set(chosen) == {"idiot", "cass*"} and chosen["idiot"] > chosen["cass*"] > 2
    more = toxicity.choose(tox, rest | {"trash": 300}, 100, 900)
    assert set(more) == {"cass*", *toxicity.DEFAULT_WORDS} - {"trash"} and more["idiot"] > more["moron"] > 1.8
    assert toxicity.choose({}, {}, 0, 0) == dict.fromkeys(toxicity.DEFAULT_WORDS, 4.0)
    assert toxicity.entries_of("Abcde xy") == {"abcde", "abc*", "abcd*", "xy"}


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op9_toxicity(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    good = bad = missed = 0
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and i in labels:
            good += r.predicted and labels[i]
            bad += r.predicted and not labels[i]
            missed += labels[i] and not r.predicted
    assert good / (good + bad) >= 0.95 and good / (good + missed) >= 0.9


def test_held_out_labels_teach_nothing(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    lied = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    one = sorted((r.doc_id, r.score) for r in toxicity.score(docs, labels).collect())
    assert one == sorted((r.doc_id, r.score) for r in toxicity.score(docs, lied).collect())


def test_labels_weigh_in_gradually():
    """No number of labels switches from one rule to another."""
    x = lambda n: np.concatenate([toxicity.features(np.full(n, 4.0), np.full(n, 50.0)), toxicity.features(np.zeros(9 * n), np.full(9 * n, 50.0))])
    y = lambda n: np.array([1.0] * n + [0.0] * 9 * n)
    assert toxicity.fit_curve(x(0), y(0)).tolist() == list(toxicity.PRIOR_CURVE)
    curves = [toxicity.fit_curve(x(n), y(n)) for n in (0, 1, 2, 5, 9, 10, 11, 30, 100)]
    hits = [float(x(1)[0] @ c) for c in curves]
    assert hits == sorted(hits) and max(np.diff(hits[1:7])) < 1.5 and hits[-1] > 2
    assert np.isfinite(toxicity.fit_curve(x(5), np.ones(50))).all()


def test_a_repeated_id_teaches_once(spark):
    """One labelled id in more rows than there are sampled ids, equal and with other texts."""
    docs = [(i, f"plain words number{i} " + ("vileness here" if i % 2 else "kindness there")) for i in range(200)]
    hot = next(i for i in range(1, 200, 2) if zlib.crc32(str(i).encode()) % 4 != 2)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    weights, curve = toxicity.learn(frame(docs), labels)
    again, curve_again = toxicity.learn(frame(docs + [docs[hot]] * 500), labels)
    assert set(weights) & {"vileness", "vilenes*"} and again == weights and curve_again == pytest.approx(curve)
    other, _ = toxicity.learn(frame(docs + [(hot, f"oddity vileness {k}") for k in range(500)]), labels)
    assert other == weights
    rows = toxicity.sample(frame(docs + [docs[hot]] * 500), labels)
    assert rows.count() == rows.select("doc_id").distinct().count()


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, 1, 1), (2, None, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and not any(r.predicted for r in rows)
    kept = toxicity.keep_clean(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.score(no_docs, labels).collect() == [] and toxicity.score(odd_docs, labels.limit(0)).count() == odd_docs.count()
    bad = spark.createDataFrame([(1, "you idiot, you moron, you scum"), (2, "a fine day")], "doc_id long, text string")
    assert [r.doc_id for r in toxicity.keep_clean(bad, labels.limit(0)).collect()] == [2]
