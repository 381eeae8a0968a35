"""Score tables that stay in place, and the site filter."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vartab import operators as ops
from vartab import sinks, sources
from vartab.operators import site_filter
from vartab.operators.scores import SITE_KEYS
from vartab.plans import inputs as I
from vartab.plans import queries as Q
from vartab.plans.fixtures import Fixtures


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_SMALL)


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _branches(plan: str) -> list[list[str]]:
    """For every leaf of a plan's text, the operators above it up to the first join."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    out, above = [], []
    for line in plan.splitlines():
        if not line.strip():
            break
        while above and above[-1][0] >= depth(line):
            above.pop()
        above.append((depth(line), line))
        if "FileScan" in line or "Scan " in line:
            path = [text for _, text in above]
            last = max((i for i, t in enumerate(path) if "Join" in t), default=-1)
            out.append(path[last + 1:])
    return out


def _tables(spark, fx, path):
    sinks.write_bucketed_scores(fx.fx_splice, path, buckets=6)
    return sources.read_bucketed(spark, path)


def test_bucketed_lookup_leaves_the_scores_in_place(spark, fx, tmp_out, no_auto_broadcast):
    table = _tables(spark, fx, tmp_out)
    pairs = ops.gene_version_map(I.gtf_gene_rows(fx), fan_out=True)
    found = ops.splice_lookup(Q._filtered(fx), table, pairs, broadcast_bytes=None)
    scores = [b for b in _branches(_plan(found)) if "AbSplice" in b[-1]]
    assert scores and all("Bucketed: true" in b[-1] or "SelectedBucketsCount: 6" in b[-1] for b in scores)
    assert not any("Exchange" in line for b in scores for line in b)
    plain = ops.splice_lookup(Q._filtered(fx), fx.fx_splice, pairs, broadcast_bytes=None)
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0 < plain.count()


def test_the_variants_are_dealt_once_for_all_bucketed_sources(spark, fx, tmp_out, no_auto_broadcast):
    table = _tables(spark, fx, tmp_out)
    sources_ = {n: (table, ["AbSplice_DNA_max"]) for n in ("one", "two", "three")}
    plan = _plan(ops.lookup_scores(fx.fx_variant.select("variant_id", *SITE_KEYS), sources_, broadcast_bytes=None))
    assert plan.count("Exchange hashpartitioning(chrom") + plan.count("REPARTITION_BY_NUM") == 2 * plan.count("REPARTITION_BY_NUM")
    scores = [b for b in _branches(plan) if "AbSplice" in b[-1]]
    assert len(scores) == 3 and not any("Exchange" in line for b in scores for line in b)


def test_bucketed_table_is_found_again_and_replaced(spark, fx, tmp_out):
    assert not sources.is_bucketed(spark, tmp_out)
    table = _tables(spark, fx, tmp_out)
    assert sources.is_bucketed(spark, tmp_out) and table.buckets == 6
    spark.sql(f"DROP TABLE {sources.bucketed.bucketed_name(tmp_out)}")  # as in another session
    again = sources.read_bucketed(spark, tmp_out)
    assert again.df.count() == fx.fx_splice.count()
    sinks.write_bucketed_scores(fx.fx_splice.limit(10), tmp_out, buckets=3)
    again = sources.read_bucketed(spark, tmp_out)
    assert again.buckets == 3 and again.df.count() == 10


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_site_filter_loses_nothing(spark, n):
    rows = spark.range(40_000).select(F.concat(F.lit("chr"), F.col("id") % 5).alias("chrom"), F.col("id").alias("start"),
                                      F.lit("A").alias("ref"), F.when(F.col("id") % 7 > 0, "C").alias("alt"))
    sites = rows.filter(F.col("start") % (40_000 // n) == 0 if n else F.lit(False))
    made = site_filter.build(sites, SITE_KEYS, 1 << 26)
    kept = site_filter.reduce_by(rows, made)
    assert kept.columns == rows.columns
    whole = sites.dropna()
    assert whole.join(kept, list(SITE_KEYS), "left_anti").count() == 0
    assert kept.count() - whole.count() <= 0.03 * 40_000
    assert kept.exceptAll(rows).count() == 0


def test_site_filter_respects_its_bound(spark):
    sites = spark.range(100_000).select(F.lit("1").alias("chrom"), F.col("id").alias("start"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    assert site_filter.build(sites, SITE_KEYS, 20_000) is None
    tight = site_filter.build(sites, SITE_KEYS, 80_000)
    assert tight.n_blocks < site_filter.build(sites, SITE_KEYS, 1 << 26).n_blocks <= 100_000 * 12 // 32768 + 1
    assert site_filter.reduce_by(sites, tight).count() == 100_000


def test_filtered_lookup_shuffles_few_score_rows(spark, fx):
    sites = fx.fx_variant.filter("start % 50 = 0").select("variant_id", *SITE_KEYS)
    made = site_filter.build(sites, SITE_KEYS, 1 << 26)
    scores = fx.fx_splice
    left, match = site_filter.reduce_by(scores, made).count(), scores.join(sites, list(SITE_KEYS), "left_semi").count()
    assert match <= left <= match + 0.03 * scores.count() < scores.count()
    pairs = ops.gene_version_map(I.gtf_gene_rows(fx), fan_out=True)
    one, two = (ops.splice_lookup(sites, scores, pairs, broadcast_bytes=b) for b in (0, None))
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0
