import numpy as np
import pytest

from llm_fixtures import SF_SMALL
from vartab.llm import whitening
from vartab.llm.common import table
from vartab.llm.queries import op12_qdwh_whitening


def spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [1], [2, 1], [1, 1, 1, 1], [3, 3, 3, 1, 1, 1, 0, 0], [1e6, 1, 1e-6, 0], [0, 0, 0], [7, 0, 0, 0, 0],
    list(np.linspace(1, 9, 64)), list(np.random.default_rng(0).exponential(size=64)), [1 + 1e-9, 1, 0.5, 0.25],
    [10, 1, 1, 1, 1, 1, 1, 1], list(2.0 ** -np.arange(40)), [4, 3.999999, 2, 1, 0.999999, 0.5]])
def test_components_like_eigh(values):
    a = spectrum(values)
    e, v = whitening.leading_components(a, 4)
    k, scale = min(4, len(values)), max(1, np.abs(values).max())
    assert np.allclose(e, sorted(values, reverse=True)[:k], atol=1e-13 * scale * len(values))
    assert np.allclose(v.T @ v, np.eye(k), atol=1e-13)
    assert np.linalg.norm(a @ v - v * e) <= 1e-13 * scale * len(values)


def test_polar_factor_is_the_sign():
    a = spectrum([3, 2, 1e-7, -1e-5, -4])
    u = whitening.polar_factor(a)
    w, q = np.linalg.eigh(a)
    assert np.allclose(u, (q * np.sign(w)) @ q.T, atol=1e-8) and np.allclose(u @ u, np.eye(5), atol=1e-13)


def brute(vectors, k):
    x = np.floor(256 * np.array(vectors, float)).astype(int)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = u - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, dev, (x - s / n) @ q / np.sqrt(e), e / np.trace(v)


def test_given_embeddings_like_numpy(spark):
    p = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    n, dev, white, explained = brute([v for _, v in p], 4)
    got = {(r.vec_id, r.component): r for r in op12_qdwh_whitening(spark, SF_SMALL).collect()}
    assert len(got) == 4 * len(p)
    for c in range(4):
        mine = np.array([got[i, c + 1].whitened for i, _ in p])
        sign = np.sign(mine @ white[:, c])
        assert np.allclose(sign * mine, white[:, c], atol=1e-9)
    for (i, _), d in zip(p, dev):
        r = got[i, 1]
        assert r.n == n and r.deviation == d and r.identity_error < 1e-10 and abs(r.explained / explained[0] - 1) < 1e-10


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.5, 0.25]), (None, [0.0, 1.0]), (2, None), (3, []), (4, [None, 1.0]),
            (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [-0.0, -0.001]), (9, [0.5, 0.25])]
    v = spark.createDataFrame([(a, b, "x", 1, 2) for a, b in rows],
                              "vec_id long, embedding array<double>, x string, d int, component int")
    got = whitening.whiten(v).collect()
    two = [r for r in got if r.n_dims == 2]
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.component) for r in two) == \
        sorted((i, c) for i in (0, 1, 1, -1, 8, 9) for c in (1, 2))
    plain = [b for _, b in rows if b and len(b) == 2 and all(x is not None and np.isfinite(x) for x in b)]
    n, dev, white, explained = brute(plain, 2)
    assert {r.n for r in two} == {n} == {4} and {r.deviation for r in two} == set(dev)
    assert np.allclose(sorted(abs(r.whitened) for r in two), sorted(abs(white).ravel()), atol=1e-9)
    (three,) = {(r.n, r.whitened, r.explained, r.identity_error, r.deviation) for r in got if r.n_dims == 3}
    assert three == (1, None, None, None, 0)
    assert whitening.whiten(v.limit(0)).collect() == []


def test_large_entries_are_exact(spark):
    v = spark.createDataFrame([(0, [1e12, 1.0]), (1, [-1e12, 2.0]), (2, [1e30, 0.0]), (3, [4.0, 1e12])], "vec_id long, embedding array<double>")
    near = whitening.whiten(v.filter("vec_id < 2")).collect()
    assert {r.deviation for r in near} == {None} and all(abs(abs(r.whitened) - 1) < 1e-9 for r in near if r.component == 1)
    small = spark.createDataFrame([(0, [2.0 ** 20, 1.0]), (1, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(small).collect()} == {2 ** 56 + 256 ** 2}
    assert len(whitening.whiten(v).collect()) == 8


def test_repeated_rows_don_t_change_the_fit(spark):
    v = table(spark, SF_SMALL, "embeddings")
    one = {(r.vec_id, r.component): (r.n, r.deviation) for r in whitening.whiten(v).collect()}
    hot = v.unionByName(v.filter("vec_id = 3").crossJoin(spark.range(500)).drop("id")).repartition(7)
    assert {(r.vec_id, r.component): (r.n, r.deviation) for r in whitening.whiten(hot).collect()} == one
