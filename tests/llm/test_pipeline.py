import hashlib

import __spark_entry__ as entry
import corpus_pipeline
from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import secrets
from vartab.llm.common import stored, table
from vartab.llm.oracles import ORACLES
from vartab.llm.queries import QUERIES, vocabulary
from vartab.plans.compare import compare_query

import pytest


def test_registration():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= names and "pipeline" in names and set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    ok, message = compare_query(spark, duck, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, message


def test_run_is_the_stages_one_after_another(spark):
    """Each stage against what its operator says of the stage's own input."""
    from test_decontam import verbatim
    from test_jaccard import brute

    docs = table(spark, SF_SMALL, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF_SMALL), "test")
        if name != "bpe":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = ({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()})
        docs = out
    scores = {r.doc_id: r.predicted for r in entry.queries()["op9_toxicity"](spark, SF_SMALL).collect()}
    before, after = seen["toxicity"]
    assert set(after) == {i for i in before if not scores[i]}
    before, after = seen["near_duplicates"]
    assert set(after) == {c for _, c, _ in brute([(i, r.text) for i, r in before.items()])}
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    assert set(after) == set(before) - {i for i, _ in verbatim([(i, r.text) for i, r in before.items()], items)}
    before, after = seen["secrets"]
    assert set(after) == set(before) and all(r.n_chars == len(r.text) for r in after.values())
    assert all((r.text == before[i].text) != ("[SECRET]" in r.text) for i, r in after.items())
    clean = secrets.scan(spark.createDataFrame(list(after.values()))).filter("spans <> ''")
    assert clean.count() == 0
    before, after = seen["bpe"]
    v = vocabulary()
    for i, r in after.items():
        ids = v.encode([before[i].text])[0]
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(tuple, after.values()))


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF_SMALL), "odd")
            docs.count()
