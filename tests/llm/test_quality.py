import zlib

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import quality
from vartab.llm.common import table
from vartab.llm.queries import op11_factorisation_machine

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op11_factorisation_machine(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    right = {0: [], 1: []}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and i in labels:
            right[labels[i]].append(r.predicted == labels[i])
    assert np.mean(right[1]) >= 0.99 and np.mean(right[0]) >= 0.93


def test_held_out_labels_teach_nothing(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    lied = labels.selectExpr("doc_id", "toxic", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    one = sorted((r.doc_id, r.score) for r in quality.score(docs, labels).collect())
    two = sorted((r.doc_id, r.score) for r in quality.score(docs.repartition(5), lied).collect())
    assert [i for i, _ in one] == [i for i, _ in two] and np.allclose([s for _, s in one], [s for _, s in two], atol=1e-12)


def test_linear_time_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    bags = [(np.sort(rng.choice(64, 9, replace=False)).astype("<u4"), rng.random(9).astype("<f4")) for _ in range(40)]
    numbers = rng.normal(size=(40, 3))
    numbers[5, 1] = np.nan
    m = quality.fit_machine(bags, numbers, (rng.random(40) < 0.5).astype(float), buckets=64, epochs=3)
    owner = np.repeat(np.arange(40), 9)
    at, index, values = m.rows(owner, np.concatenate([b for b, _ in bags]).astype(np.int64),
                               np.concatenate([v for _, v in bags]).astype(float), numbers)
    line, _ = m.raw(40, at, index, values)
    for t in range(40):
        i, x = index[at == t], values[at == t]
        pairs = sum(m.factors[i[a]] @ m.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert line[t] == pytest.approx(m.bias + m.weights[i] @ x + pairs)
    assert len(index[at == 5]) == 9 + 3 + 2 and len(index[at == 6]) == 9 + 3 + 3


def test_interactions_are_learned():
    """Labels that are the product of two inputs: no weights alone can tell them."""
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 2, 2000), rng.integers(0, 2, 2000)
    bags = [(np.array([x, 2 + y], "<u4"), np.ones(2, "<f4")) for x, y in zip(a, b)]
    y = (a ^ b).astype(float)
    m = quality.fit_machine(bags[:1500], np.zeros((1500, 1)), y[:1500], buckets=8, epochs=60)
    assert np.mean([(m.raw(1, np.zeros(2 + 2, int), np.array([*bags[i][0], 8, 8 + 2], int), np.array([1, 1, 0, 0.5]))[0][0] > 0) == y[i]
                    for i in range(1500, 2000)]) > 0.99


def slow_inputs(text, buckets):
    words = text.split()
    h = [int(quality.hash_words([w]).hashes[0]) % buckets for w in words]
    v = {k: np.log1p(h.count(k)) for k in set(h)}
    norm = np.sqrt(sum(x * x for x in v.values()))
    return {k: x / norm for k, x in v.items()}, words


@pytest.mark.parametrize("slice_bytes", [7, 30, 1 << 20])
def test_inputs_don_t_depend_on_slices(monkeypatch, slice_bytes):
    monkeypatch.setattr(quality, "SLICE_BYTES", slice_bytes)
    texts = [b"", b"one one two", b" \n ", b"AAA bb!! || 12 %%% bb!!", b"x" * 50, b"a a a a a a a a a a a a a a a a a"]
    owner, bucket, value, stats = quality.inputs_of(texts, 1 << 14)
    for i, t in enumerate(texts):
        want, words = slow_inputs(t, 1 << 14)
        got = dict(zip(bucket[owner == i].tolist(), value[owner == i].tolist()))
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
        by = dict(zip(quality.STATISTICS, stats[i], strict=True))
        assert by["log_words"] == np.log1p(len(words)) and by["log_bytes"] == np.log1p(len(t))
    by = dict(zip(quality.STATISTICS, stats[3], strict=True))
    assert by["bars"] == 2 / 6 and by["bangs"] == 4 / 6 and by["signs"] == 3 / 6 and by["upper"] == 3 / 7
    if slice_bytes > 1000:
        assert dict(zip(quality.STATISTICS, stats[1]))["repeated_words"] == 1 / 3


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (None, 1, 1), (2, None, None), (7, 0, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    rows = quality.score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.score(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(no_docs, labels).collect() == []
    same = [r.score for r in quality.score(odd_docs.filter("doc_id in (5, 6)"), labels).collect()]
    assert len(same) == 2 and same[0] == same[1]


def test_a_repeated_id_teaches_once(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    hot = docs.unionByName(docs.filter("doc_id = 3").crossJoin(spark.range(400)).drop("id"))
    assert quality.sample(hot, labels, ["n_chars"]).count() == quality.sample(docs, labels, ["n_chars"]).count()
