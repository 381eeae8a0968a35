"""Invariants and plan shape: binned join = plain range join, toggles only
remove rows, writers keep their promises, no cross products in any
registered query, scans prune columns and push filters."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vartab import operators as ops
from vartab import sinks
from vartab.plans import inputs as I
from vartab.plans import queries as Q
from vartab.plans.fixtures import Fixtures
from vartab.plans.queries import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_SMALL)


@pytest.mark.parametrize("bin_size", [100, 10_000, 1_000_000])
def test_binned_join_equals_range_join(spark, fx, bin_size):
    v = fx.fx_variant.select("variant_id", F.replace("chrom", F.lit("chr"), F.lit("")).alias("chrom"),
                             F.col("start").alias("pos"))
    e = fx.fx_enhancer.select(F.col("id").alias("eid"), F.col("chromosome").alias("chrom"),
                              "start", "end")
    binned = ops.interval_join(v, e, point_pos="pos", bin_size=bin_size).select("variant_id", "eid")
    plain = ops.interval_join(v, e, point_pos="pos", bin_size=None).select("variant_id", "eid")
    assert binned.count() == plain.count() > 0
    assert binned.exceptAll(plain).count() == 0


def test_toggles_only_remove_rows(spark, fx):
    base = Q._base(fx)
    n = base.count()
    for pc, canon in [(True, False), (False, True), (True, True)]:
        t = ops.toggle_filter(base, pc, canon)
        assert t.count() <= n
        assert t.exceptAll(base).count() == 0


def test_combine_keeps_base_rows_when_parts_are_unique(spark):
    n_base = Q.q_base_table(spark, SF_SMALL).count()
    assert Q.q_combine_all(spark, SF_SMALL).count() <= n_base
    for name in ["combine_none", "combine_vep", "combine_nmd", "combine_e2g", "combine_splice"]:
        assert Q.QUERIES[name](spark, SF_SMALL).count() == n_base


def test_vcf_chunks_are_standalone_with_at_most_n_rows(spark, fx, tmp_out):
    vcf = ops.filter_variants(I.vcf_rows(fx), ops.analysis_set(Q._base(fx), 500))
    metrics = sinks.write_vcf_chunks(vcf.repartition(3), I.VCF_HEADER, tmp_out, 700)
    files = sorted(glob.glob(tmp_out.removeprefix("file:") + "/chunk=*/part-*"))
    assert len(files) >= 3
    n_data = 0
    for f in files:
        with open(f) as h:
            lines = h.read().splitlines()
        assert lines[: len(I.VCF_HEADER)] == I.VCF_HEADER
        body = lines[len(I.VCF_HEADER):]
        assert 0 < len(body) <= 700 and not any(b.startswith("#") for b in body)
        n_data += len(body)
    assert n_data == metrics["rows"] == vcf.count()


def test_chunks_hold_at_most_n_rows(spark, fx, tmp_out):
    sinks.write_chunks(Q._filtered(fx), tmp_out, 700)
    per_file = (spark.read.parquet(tmp_out).groupBy(F.input_file_name()).count()
                .agg(F.max("count"), F.count("*")).collect()[0])
    assert per_file[0] <= 700 and per_file[1] >= 2


def test_sorted_gtf_is_in_genome_order(spark, fx, tmp_out):
    gtf = I.gtf_gene_rows(fx).unionByName(I.gtf_transcript_rows(fx))
    sinks.write_text(I.gtf_lines(sinks.sort_by_position(gtf, "seqname", "start")),
                     I.GTF_HEADER, tmp_out, compression="gzip")
    path = tmp_out.removeprefix("file:")
    lines = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        with gzip.open(f, "rt") as h:
            lines += h.read().splitlines()
    assert lines[: len(I.GTF_HEADER)] == I.GTF_HEADER
    keys = [(ln.split("\t")[0], int(ln.split("\t")[3])) for ln in lines[len(I.GTF_HEADER):]]
    assert keys == sorted(keys) and len(keys) == gtf.count()


def test_overwrite_drops_stale_partitions(spark):
    df = Q.q_overwrite_drops_stale(spark, SF_SMALL)
    assert df.filter(~F.col("canonical")).count() == 0


def test_broadcast_only_below_bound(spark):
    small = spark.range(10)
    assert "ResolvedHint" in small.hint("broadcast")._jdf.queryExecution().analyzed().toString()
    assert ops.measured_bytes(small) == 10 * 40  # a long and the row overhead
    wide = spark.createDataFrame([("x" * 100, None)], "a string, b binary")
    assert ops.measured_bytes(wide) == 32 + 116 + 16
    hinted = ops.broadcast_if_small(small, 400)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    plain = ops.broadcast_if_small(small, 399)
    assert "broadcast" not in plain._jdf.queryExecution().analyzed().toString().lower()


def test_measuring_never_meets_in_one_task(spark, monkeypatch):
    seen = []
    from pyspark.sql.classic.dataframe import DataFrame
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (seen.append(_plan(self)), collect(self))[1])
    ops.measured_bytes(spark.range(0, 1000, 1, 20))
    assert seen and all("SinglePartition" not in p for p in seen)


def test_csq_is_extracted_and_split_once(spark, fx):
    plan = _plan(ops.explode_csq(I.vcf_rows(fx).select("*")))
    below = plan[plan.index("Generate"):]
    assert below.count("regexp_extract") == 1 and "Filter" not in below.split("Scan")[0].split("Generate", 1)[1].split("Project")[0]


def test_near_gene_joins_no_pairs(spark, fx):
    plan = _plan(ops.near_gene(fx.fx_variant, I.transcripts(fx), I.exons(fx), 1000, broadcast_bytes=None))
    assert "variant_id" not in " ".join(ln for ln in plan.splitlines() if "Join" in ln)


def test_lookup_prunes_partitions(spark, fx, tmp_out):
    sinks.compact_scores(fx.fx_splice, tmp_out)
    from vartab import sources
    few = fx.fx_variant.filter("chrom = 'chr2'")
    plan = _plan(ops.lookup_scores(few, {"s": (sources.read_score_files(spark, tmp_out), ["AbSplice2_max"])}, prune=True))
    assert "PartitionFilters: [cast(chrom" in plan or "PartitionFilters: [(chrom" in plan or "PartitionFilters: [isnotnull(chrom" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark, fx):
    df = fx.fx_prediction.filter(F.col("model") == "scE2G").select("enhancer_id")
    plan = _plan(df)
    assert "PushedFilters" in plan
    assert "o_comment" not in plan.split("ReadSchema")[-1]


def test_interval_join_is_equi_join_on_bin(spark, fx):
    plan = _plan(Q.q_interval_overlap(spark, SF_SMALL))
    assert ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan)
    assert "_bin" in plan and "BroadcastNestedLoopJoin" not in plan


def test_compact_scores_round_trip(spark, fx, tmp_out):
    from vartab import sources

    src = tmp_out + "/src"
    fx.fx_splice.repartition(7).write.parquet(src + "/x")
    out = tmp_out + "/compact"
    sinks.compact_scores(sources.read_score_files(spark, src), out)
    back = spark.read.parquet(out)
    assert back.count() == fx.fx_splice.count()
    plan = _plan(back.filter(F.col("chrom") == "chr2").select("start"))
    assert "PartitionFilters: [isnotnull(chrom" in plan


def test_score_files_mixed_types_nested(spark, fx, tmp_out):
    from vartab import sources

    s = fx.fx_splice
    s.filter("chrom = 'chr1'").write.parquet(tmp_out + "/g1/a.parquet")
    s.filter("chrom = 'chr2'").withColumn("start", F.col("start").cast("string")) \
        .write.parquet(tmp_out + "/g2/deep/b.parquet")
    s.filter("chrom = 'chr3'").withColumn("start", F.col("start").cast("int")) \
        .write.parquet(tmp_out + "/g3.parquet")
    back = sources.read_score_files(spark, tmp_out)
    assert dict(back.dtypes)["start"] == "bigint"
    assert back.exceptAll(s.select(*back.columns)).count() == 0
    assert back.count() == s.count()


def test_sorted_export_is_in_order_and_verbatim(spark, tmp_out):
    from vartab import sources

    lines = ["chr2\ta\tgene\t5\t9\t.\t+\t.\tx \"1\";", "chr1\ta\tgene\t70\t90\t.\t-\t.\ty;", "chr1\ta\tgene\t9\t10\t.\t+\t.\t"]
    sinks.write_text(spark.createDataFrame([(x,) for x in lines], "value string"), ["#h"], tmp_out + "/in")
    sinks.sort_annotation(sources.read_gtf(spark, tmp_out + "/in", keep_line=True), ["#h"], tmp_out + "/out")
    got = [r.value for r in spark.read.text(tmp_out + "/out").collect() if not r.value.startswith("#")]
    assert got == [lines[2], lines[1], lines[0]]
