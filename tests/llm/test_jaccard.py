import random

import pytest

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import graph, jaccard
from vartab.llm.common import table
from vartab.llm.queries import op7_bayes_jaccard


def shingles(text):
    w = jaccard.plain(text).split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, least doc_id of the class, links) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    n, links = len(rows), [0] * len(rows)
    group = list(range(n))
    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i], links[j] = links[i] + 1, links[j] + 1
                group[find(i)] = find(j)
    ids = {}
    for i in range(n):
        ids.setdefault(find(i), []).append(rows[i][0])
    least = {k: None if None in v else min(v) for k, v in ids.items()}
    return sorted(((rows[i][0], least[find(i)], links[i]) for i in range(n)), key=str)


def found(df, **kw):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(df, **kw).collect()), key=str)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = sorted((tuple(r) for r in op7_bayes_jaccard(spark, SF_SMALL).select("doc_id", "class_id", "n_links").collect()), key=str)
    assert got == brute(rows) and any(r[2] for r in got)


@pytest.fixture(scope="module")
def family(spark):
    """A chain of edits (so that its ends are not similar), a large group of near
    copies, exact copies and documents that share one passage only."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows, chain = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(chain)))
        for _ in range(2):
            chain[rng.randrange(len(chain))] = word()
    other = [word() for _ in range(90)]
    for i in range(40):
        copy = list(other)
        copy[rng.randrange(90)] = word()
        rows.append((100 + i, " ".join(copy)))
    rows += [(200 + i, " ".join(other)) for i in range(15)]
    rows += [(300 + i, " ".join(other[:30] + [word() for _ in range(60)])) for i in range(10)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("kw", [{}, {"bucket_chunk": 4, "component_chunk": 3}, {"component_chunk": 16}])
def test_chains_and_groups(family, kw):
    rows, docs = family
    assert found(docs, **kw) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(odd_docs) == brute(rows)
    assert found(no_docs) == []


def test_keep_one(odd_docs, no_docs, family):
    kept = jaccard.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    got = sorted(((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()), key=str)
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    long = next(t for i, t in texts if i == 7)
    want = [(1, "one two three four five six seven"), (None, "no id here but seven words"), (None, None), (3, ""), (4, None),
            (5, "one"), (7, long), (9, "x" * 50_000), (10, " \n\t "), (11, "é漢字 \U0001f600 ünï")]
    assert got == sorted(want, key=str)
    assert jaccard.keep_one(no_docs).collect() == []
    rows, docs = family
    assert sorted(r.doc_id for r in jaccard.keep_one(docs).collect()) == sorted({c for _, c, _ in brute(rows)})


def test_pruning_rule_keeps_pairs_at_the_threshold():
    rule = jaccard.least_matches(160, 32, 0.8, 1e-4)
    assert [n for n, _ in rule] == [32, 64, 96, 128, 160]
    assert all(m <= 0.8 * n for n, m in rule)  # the expected matches of a pair at the threshold pass
    assert all(m >= 0.5 * n for n, m in rule)


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(300, 300), (400, 401), (401, 400)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), 400: 400, 401: 400}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_with_hubs(spark):
    rng = random.Random(4)
    edges = [(0, i) for i in range(1, 400)] + [(9_000, 9_000 - i) for i in range(1, 300)] + [(rng.randrange(20_000, 20_300), rng.randrange(20_000, 20_300)) for _ in range(250)]
    edges += [(30_000 + i, 30_001 + i) for i in range(60)] + [(399, 30_060), (5, 5)]
    rng.shuffle(edges)
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            label[y] = x
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in label}
