import random

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import decontam
from vartab.llm.common import table
from vartab.llm.jaccard import plain
from vartab.llm.queries import op1_latent_decontamination


def verbatim(docs, items):
    out = set()
    for i, t in docs:
        text = b" " + b" ".join(plain(t).split()) + b" "
        out |= {(i, k) for k, x in items if b" " + b" ".join(plain(x).split()) + b" " in text}
    return out


def test_lcs():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert decontam.lcs(a, b) == t[-1, -1]


def test_whole_table_finds_all_verbatim_items_and_nothing_else(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    rows = op1_latent_decontamination(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == verbatim(docs, items)


@pytest.fixture(scope="module")
def planted(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect() if r.text][:120]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    clean = [d for d in docs if not verbatim([d], items)]
    return clean, items


def test_paraphrases_are_found_and_clean_hosts_are_not(spark, planted):
    """One word in ten replaced and one in ten dropped, anywhere in a document."""
    clean, items = planted
    rng = random.Random(4)
    rows = []
    for k, text in items:
        words = [rng.choice(rng.choice(clean)[1].split()) if rng.random() < 0.1 else w for w in text.split() if rng.random() > 0.1]
        host = rng.choice(clean)[1].split()
        at = rng.randint(0, len(host))
        rows.append((1000 + k, " ".join(host[:at] + words + host[at:])))
    found = decontam.contaminated(spark.createDataFrame(clean + rows, "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sum(r.doc_id == 1000 + r.item_id for r in found) >= 0.9 * len(items)
    assert all(r.doc_id >= 1000 for r in found)


def test_short_items_and_what_the_rule_accepts_are_found(spark, planted):
    """Verbatim runs of 5 to 14 words, and every paraphrase (one word in five
    replaced) that shares the weight and the subsequence step 3 asks for."""
    clean, items = planted
    rng = random.Random(6)
    short, rows, sure = [], [], set()
    for k in range(200):
        size = 5 + k % 10
        words = plain(rng.choice(items)[1]).decode().split()
        at = rng.randint(0, len(words) - size)
        short.append((k, " ".join(words[at:at + size])))
        host = rng.choice(clean)[1].split()
        at = rng.randint(0, len(host))
        rows.append((1000 + k, " ".join(host[:at] + [short[k][1]] + host[at:])))
        put = [f"q{rng.randrange(10**6)}" if rng.random() < 0.2 else w for w in short[k][1].split()]
        if sum(a == b for a, b in zip(put, short[k][1].split())) >= 0.8 * size:
            sure.add(k)
        rows.append((2000 + k, " ".join(host[:at] + put + host[at:])))
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(
        spark.createDataFrame(clean + rows, "doc_id long, text string"),
        spark.createDataFrame(short, "item_id long, text string")).collect()}
    assert {(1000 + k, k) for k in range(200)} <= found
    # a replaced word may carry more than half of a short item's weight; then step 3 refuses
    assert len(sure) > 100 and sum((2000 + k, k) in found for k in sure) >= 0.95 * len(sure)


def test_passes_over_items_give_the_same(spark, planted):
    clean, items = planted
    docs = spark.createDataFrame(clean[:20] + [(2000 + k, clean[0][1] + " " + t) for k, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    many = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, items_per_pass=7).collect()}
    assert one == many and {(2000 + k, k) for k, _ in items} <= one
    assert {r.doc_id for r in decontam.drop_contaminated(docs, bench, items_per_pass=7).collect()} == {i for i, _ in clean[:20]}


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "w10 w11 w12 w13 w14 w15 w16 w17 w18"), (1, "w10 w11 w12 w13 w14 w15 w16 w17 w18"), (2, None), (3, ""), (4, "one two"),
             (None, "w20000 w20001 w20002 w20003 w20004 w20005 w20006"), (5, "not in any of the documents at all here")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    found = decontam.contaminated(odd_docs, bench).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in found) == [(7, 0), (7, 1), (8, 0), (8, 1)]
    kept = decontam.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2
    assert decontam.contaminated(no_docs, bench).collect() == [] and decontam.contaminated(odd_docs, bench.limit(0)).collect() == []
    assert decontam.drop_contaminated(no_docs, bench).collect() == []
    assert decontam.drop_contaminated(odd_docs, bench.limit(0)).count() == odd_docs.count()
    left_out = [(r.item_id, r.text, r.n_words) for r in decontam.unsearched_items(bench).collect()]
    assert sorted(left_out) == [(2, None, 0), (3, "", 0), (4, "one two", 2)]
