"""Hot keys: one bin / one partition value holding a third of all rows is
split over several tasks, never handled by one."""

import contextlib
import glob

from pyspark.sql import functions as F

from vartab import operators as ops
from vartab import sinks


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _final_plan(df):
    """Run the DataFrame's own query execution, then read its final
    adaptive plan (another action would plan a new execution)."""
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


def test_hot_bin_is_split_by_adaptive_skew_join(spark):
    n = 300_000
    # a third of the points sit in bin 0 of chr 1, the rest spread widely
    pts = spark.range(n).select(
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("variant_id"),
        F.lit("1").alias("chrom"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 9000)
         .otherwise(F.col("id") * 50 + 20_000).alias("pos"))
    iv = spark.range(2000).select(F.col("id").alias("iid"), F.lit("1").alias("chrom"),
                                  (F.col("id") * 7500).alias("start"),
                                  (F.col("id") * 7500 + 900).alias("end"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                        "spark.sql.shuffle.partitions": "16"}):
        out = ops.interval_join(pts, iv, point_pos="pos").select("variant_id", "iid")
        n_out, plan = _final_plan(out)
        expected = (pts.join(iv, (pts.pos >= iv.start) & (pts.pos < iv.end)).count())
        assert n_out == expected > 0
    assert "SortMergeJoin(skew=true)" in plan, plan[:2000]


def test_dominant_partition_is_written_by_several_tasks(spark, tmp_out):
    n = 200_000
    df = spark.range(n).select(
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("variant_id"),
        F.when(F.col("id") % 10 < 8, "SNV").otherwise("indel").alias("variant_type"),
        F.when(F.col("id") % 10 < 7, "protein_coding").otherwise("lncRNA").alias("gene_type"),
        (F.col("id") % 2 == 0).alias("canonical"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
                        "spark.sql.shuffle.partitions": "16"}):
        metrics = sinks.write_annotations(df, tmp_out)
    assert metrics["rows"] == n
    path = tmp_out.removeprefix("file:")
    hot = glob.glob(f"{path}/variant_type=SNV/gene_type=protein_coding/canonical=true/*.parquet")
    assert len(hot) > 1


def test_gene_maps_are_broadcast_so_hot_genes_never_shuffle(spark):
    from conftest import SF_SMALL
    from vartab.plans.queries import QUERIES

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for name in ("splice_lookup", "e2g"):
            plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "LeftOuter, BuildRight" in plan, name


def test_small_variant_side_is_broadcast_against_scores(spark):
    from conftest import SF_SMALL
    from vartab.plans.queries import QUERIES

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = QUERIES["splice_lookup"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [chrom" in plan and "Inner" in plan, plan[:1500]


def test_score_tables_are_reduced_by_a_broadcast_semi_join(spark):
    from conftest import SF_SMALL
    from vartab.plans.queries import QUERIES

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = QUERIES["score_lookup"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan and "BroadcastHashJoin" in plan, plan[:1500]
