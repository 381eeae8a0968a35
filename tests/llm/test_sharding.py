import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import sharding
from vartab.llm.common import table
from vartab.llm.queries import op10_feistel_sharding


def check(rows, texts, shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    by = {}
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    one = op10_feistel_sharding(spark, SF_SMALL).collect()
    check(one, texts, 24)
    again = sharding.shard_rows(docs.repartition(7)).collect()
    assert sorted(one) == sorted(again)  # the same whatever the partitions


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_odd_rows(odd_docs, no_docs, shards):
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    check(sharding.shard_rows(odd_docs, shards).collect(), texts, shards)
    assert sharding.shard_rows(no_docs, shards).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 101, 4096])
def test_permutation_is_a_bijection(spark, n):
    a, b = sharding.domain(n)
    assert n <= a * b < n + a
    places = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, "k")).collect()]
    assert sorted(places) == list(range(n))
    if n > 100:
        assert places != sorted(places)


def test_repeated_rows_are_counted_not_gathered(spark):
    docs = spark.createDataFrame([(1, "same")] * 500 + [(2, "other")], "doc_id long, text string")
    check(sharding.shard_rows(docs, 24).collect(), [(1, "same")] * 500 + [(2, "other")], 24)
