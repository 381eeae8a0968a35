import numpy as np
import pytest

from llm_fixtures import SF_SMALL
from vartab.llm import ann
from vartab.llm.common import table
from vartab.llm.queries import op3_multi_index_hashing


def brute(rows, asked, k=5):
    """(query_id, rank, vec_id, score) by the definition; rows of (vec_id, vector)."""
    out = []
    for i, (q_id, q) in enumerate(rows):
        if asked(q_id):
            q = np.array(q, float)
            scores = [(-(np.array(x) @ q) / (np.linalg.norm(x) * np.linalg.norm(q)), v) for j, (v, x) in enumerate(rows)
                      if j != i and len(x) == len(q)]
            out += [(q_id, r + 1, v, -s) for r, (s, v) in enumerate(sorted((round(s, 12), v) for s, v in scores)[:k])]
    return out


def recall(rows, found, k=5):
    want = brute(rows, lambda i: i % 50 == 0, k)
    return len({(q, v) for q, _, v, _ in want} & {(r.query_id, r.vec_id) for r in found}) / len(want)


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.1"])
def test_recall_and_scores(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    by_id = {i: np.array(v, float) for i, v in rows}
    found = op3_multi_index_hashing(spark, sf).collect()
    queries = {i for i, _ in rows if i % 50 == 0}
    assert len(found) == 5 * len(queries) and {r.query_id for r in found} == queries
    for q in queries:
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        for r in mine:
            x, y = by_id[q], by_id[r.vec_id]
            assert r.score == pytest.approx(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)), abs=1e-12)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
    assert recall(rows, found) >= 0.9


def test_clustered_vectors_need_few_probes(spark):
    """Near rows are found by a small share of all; the index leaves out the rest."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(200, 32))
    x = np.repeat(centres, 20, axis=0) + 0.05 * rng.normal(size=(4000, 32))
    rows = list(enumerate(x.tolist()))
    tell = []
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tell=tell).collect()
    assert recall(rows, found) >= 0.98
    assert [t[:2] for t in tell] == [(0, 80)]  # done with the buckets of the queries' own values
    codes = ann.encode(x, ann.learn_rotations(x))
    subs = ann.substrings(codes, 12)
    looked_at = np.mean([(subs == subs[q]).any(1).mean() for q in range(0, 4000, 50)])
    assert looked_at < 0.05


@pytest.mark.parametrize("size", [8, 11, 16])
def test_every_code_within_the_radius_is_retrieved_once(size):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 16))
    q = x[:9] + rng.normal(size=(9, 16)) * 0.3
    model = ann.learn_rotations(x)
    codes, q_codes = ann.encode(x, model), ann.encode(q, model)
    apart = np.bitwise_count(codes.view(np.uint64)[None] ^ q_codes.view(np.uint64)[:, None]).sum(2)
    m, seen, low, before = ann.BITS // size, set(), -1, -1
    for high, cut in ((0, 100), (1, 110), (3, 110), (size, ann.BITS)):
        for j in range(m):
            asks, rows, _ = ann.search_cell(j, size, low, high, np.arange(300), codes, np.arange(1000, 1009), q_codes, np.full(9, cut),
                                            np.full(9, before))
            pairs = set(zip(asks.tolist(), rows.tolist(), strict=True))
            assert len(pairs) == len(asks) and not pairs & seen
            seen |= pairs
        assert {(i, r) for i, r in np.argwhere(apart <= min(cut, m * (high + 1) - 1)).tolist()} <= seen
        low, before = high, cut
    assert len(seen) == 9 * 300


def test_prefixes_and_odds():
    row, prefix = ann.near_prefixes(np.array([0b101, 0]), 3, 1)
    assert sorted(prefix[row == 0].tolist()) == [0b001, 0b100, 0b101, 0b111]
    row, prefix = ann.near_prefixes(np.array([0, 0]), 0, 2)
    assert prefix.tolist() == [0, 0]
    c = [ann.least_cosine(t, 16, 16) for t in range(6)] + [ann.least_cosine(16, 16, 16)]
    assert c == sorted(c, reverse=True) and c[0] < 0.99 and c[-1] < -1
    assert ann.substrings(np.array([[0b10110000, 0b00001111]], np.uint8), 5).tolist() == [[0b10110, 0b00000, 0b00111]]


def frame(spark, rows):
    return spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "vec_id long, embedding array<double>, vec string, score int")


def answers(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in df.collect())


def test_odd_vectors(spark):
    good = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (9, [1.0, 2.0, 3.0]), (2, [1.0, 0.0]), (2, [1.0, 5.0]),
            (100, [3.0, 1.0, 1.0]), (150, [1.0]), (200, [-0.0, 2.0])]
    bad = [(3, None), (4, []), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]),
           (None, [1.0, 1.0]), (300, None), (350, [0.0])]
    assert answers(ann.nearest(frame(spark, good + bad))) == sorted(brute(good, lambda i: i % 50 == 0))
    assert ann.nearest(frame(spark, bad)).collect() == []
    assert ann.nearest(frame(spark, good).limit(0)).collect() == []
    assert ann.nearest(frame(spark, good), asked="vec_id < 0").collect() == []


def test_rows_that_share_an_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (7, [1.0, 0.01]), (7, [-1.0, 0.5]), (9, [0.9, 0.3])]
    got = answers(ann.nearest(frame(spark, rows)))
    assert got == sorted(brute(rows, lambda i: i == 0)) and got[0][2] == 7 and got[0][3] > 0.9999


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(900)] + [(50, [1.0, 2.0, 3.0, 4.0])] * 2
    got, want = answers(ann.nearest(frame(spark, rows).repartition(6))), sorted(brute(rows, lambda i: i % 50 == 0))
    hot = [w for w in want if w[0] % 3 == 0]
    assert [g for g in got if g[0] % 3 == 0] == hot and len(got) == len(want)


def test_cells_and_parts_don_t_change_the_result(spark):
    v = table(spark, SF_SMALL, "embeddings")
    assert answers(ann.nearest(v, cell_rows=40)) == answers(ann.nearest(v))
