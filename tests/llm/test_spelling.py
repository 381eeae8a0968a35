import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import spelling
from vartab.llm.common import table
from vartab.llm.queries import op13_spelling_variants


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(rows):
    """Near words by shared deletions, then the definition of an edit."""
    n = brute_words(rows)
    shared = defaultdict(set)
    for w in n:
        shared[w].add(w)
        for i in range(len(w)):
            shared[w[:i] + w[i + 1:]].add(w)
            shared[w[:i] + "\0" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for key, group in shared.items():
        for a in group:
            near[a] |= {b for b in group if b != a and (len(a) != len(b) and key in (a, b) or "\0" in key)}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda b: (-n[b], b))
            if n[best] >= 10 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w) or "", root(w), k, len(near[w]), n[form[w]] if w in form else None) for w, k in n.items())


def rows_of(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.fixture(scope="module")
def small(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    return brute(rows)


def test_given_documents(spark, small):
    assert rows_of(op13_spelling_variants(spark, SF_SMALL)) == small and any(r[1] for r in small)


@pytest.mark.parametrize("sample, cell_words, cell_bytes", [(300, 20, 1 << 30), (10**6, 40, 3_000), (50, 10**6, 20_000), (0, 1, 50_000)])
def test_cells_parts_and_tiles_don_t_change_the_result(spark, small, sample, cell_words, cell_bytes):
    docs = table(spark, SF_SMALL, "documents").repartition(5)
    assert rows_of(spelling.variants(docs, sample=sample, cell_words=cell_words, cell_bytes=cell_bytes)) == small


def test_edits():
    code = lambda *w: spelling.letters([x.encode("latin-1") for x in w], len(w[0]))
    assert spelling.one_replaced(code("abc", "abc", "abc", "abé"), code("abd", "abc", "cba", "abè")).tolist() == [True, False, False, True]
    longer = code("abbc", "xabc", "abcx", "axbc", "acbx", "bacd")
    assert spelling.one_inserted(code(*["abc"] * 6), longer).tolist() == [True, True, True, True, False, False]


def test_every_leaf_within_reach_is_found():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcé"), 7)) for _ in range(600)]
    counts = spelling.letter_counts(spelling.letters([w.encode("latin-1") for w in words], 7)).astype(int)
    tree = spelling.Tree.build(counts, 5)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(600))
    for up, down in ((0, 0), (1, 0), (1, 1)):
        met = {(leaf, q) for leaf, at in tree.reach(counts, up, down) for q in at.tolist()}
        for leaf, rows in enumerate(tree.leaves):
            apart = counts[rows][None] - counts[:, None]
            ok = ((np.maximum(apart, 0).sum(2) <= up) & (np.maximum(-apart, 0).sum(2) <= down)).any(1)
            assert {(leaf, q) for q in np.flatnonzero(ok).tolist()} <= met
        assert len(met) < 600 * len(tree.leaves)


def test_many_words_of_the_same_letters(spark):
    """Anagrams that no tree over letter counts can part."""
    rng = np.random.default_rng(5)
    texts = []
    for i in range(900):
        w = "".join(rng.permutation(list("aaaabbbb")))
        texts.append((i, f"{w} {w} {w}x {w[:-1]} {w[:3]}c{w[4:]} " * int(rng.choice([1, 2, 30]))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows_of(spelling.variants(docs, cell_words=10, cell_bytes=4_000)) == brute(texts)


def test_a_chain_of_forms(spark):
    words = {"abcdefg": 2, "abcdefh": 20, "abcdeih": 200, "abcjeih": 2000, "kbcjeih": 20000, "zzzzzzz": 2, "zzzzzzzz": 20, "zzzzzzzy": 20}
    texts = [(7, f"{w} " * k) for w, k in words.items()]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows_of(spelling.variants(docs))
    assert got == brute(texts)
    if all(zlib.crc32(f"7:{w}".encode()) % 31 for w in words):
        assert {r[0]: r[2] for r in got}["abcdefg"] == "kbcjeih"


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.unionByName(odd_docs.limit(0))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(spelling.variants(docs)) == brute(rows)
    assert spelling.variants(no_docs).collect() == []
    long = [(i, t) for i in range(40) for t in ("y" * 30_000, "y" * 30_001 + " caféÉxyz CaféÉxyz ×÷×÷×÷× " + "Q" * 8, "straßeĀstraßes")]
    frame = spark.createDataFrame(long + [(None, "y" * 30_000)], "doc_id long, text string")
    got = {r.word: r for r in spelling.variants(frame).collect()}
    assert {w: r.n for w, r in got.items()} == brute_words(long + [(None, "y" * 30_000)])
    assert got["y" * 30_000].n_near >= 1
