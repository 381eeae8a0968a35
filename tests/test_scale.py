"""Exact chunks, the row-local funnel, salted heavy ids, nested bins and mergeable
metrics: each against the plain way, and its plan."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vartab import operators as ops
from vartab import sinks
from vartab.operators.heavy import salt_rows
from vartab.plans import inputs as I
from vartab.plans import queries as Q
from vartab.plans.annotation import AnnotationConfig, annotation_table, base_counts
from vartab.plans.fixtures import Fixtures
from vartab.session import LISTING_TASKS


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_SMALL)


def _chunks(path):
    out = {}
    for f in glob.glob(path.removeprefix("file:") + "/chunk=*/part-*"):
        k = int(re.search(r"chunk=(\d+)", f)[1])
        assert k not in out, "a chunk is one file"
        with open(f) as h:
            out[k] = h.read().splitlines()
    return [out[k] for k in range(len(out))]


@pytest.mark.parametrize("n, rows, parts", [(10, 1000, 7), (700, 700, 3), (1000, 701, 4), (3, 0, 2), (1, 5, 2)])
def test_chunks_hold_exactly_n_lines_in_order(spark, tmp_out, n, rows, parts):
    lines = spark.range(rows, numPartitions=parts).select(F.concat(F.lit("line"), "id").alias("line"))
    assert sinks.write_vcf_chunks(lines, ["#a", "#b"], tmp_out, n)["rows"] == rows
    chunks = _chunks(tmp_out)
    assert all(c[:2] == ["#a", "#b"] for c in chunks)
    assert [len(c) - 2 for c in chunks] == [n] * (rows // n) + [rows % n] * (rows % n > 0)
    assert [x for c in chunks for x in c[2:]] == [f"line{i}" for i in range(rows)]


def test_chunks_without_header(spark, tmp_out):
    sinks.write_vcf_chunks(spark.range(5).select(F.col("id").cast("string").alias("line")), [], tmp_out, 2)
    assert [len(c) for c in _chunks(tmp_out)] == [2, 2, 1]


@pytest.mark.parametrize("pc, canon", [(False, False), (True, False), (False, True), (True, True)])
def test_lines_are_judged_without_a_shuffle(spark, fx, tmp_out, pc, canon):
    I.vcf_rows(fx).write.parquet(tmp_out)  # stored, so that the plan is that of the test alone
    vcf, base, meta = spark.read.parquet(tmp_out), Q._base(fx), Q._metadata(fx)
    for window in (0, 300):
        by_row = ops.filter_lines(vcf, meta, window, pc, canon)
        by_join = ops.filter_variants(vcf, ops.analysis_set(base, window, pc, canon))
        assert by_row.exceptAll(by_join).count() == by_join.exceptAll(by_row).count() == 0 < by_row.count()
    main = _plan(by_row).split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_lines_odd_rows(spark):
    entry = lambda gene, tr, dist: "|".join(["A", "x", "LOW", "S", gene, "T", tr] + [""] * 13 + [dist])
    meta = spark.createDataFrame([("t1", "protein_coding", True), ("t2", "lncRNA", True), (None, "protein_coding", True), ("t1", "protein_coding", True)],
                                 "transcript_id string, gene_type string, canonical boolean")
    rows = [("a", f"CSQ={entry('g', 't1', '')}"), ("b", f"X=1;CSQ={entry('g', 't2', '')},{entry('g', 't1', '9')};Y"), ("c", f"CSQ={entry('-', 't1', '')}"),
            ("d", None), ("e", ""), ("f", "CSQ="), (None, f"CSQ={entry('g', 't1', '5')}"), ("g", f"CSQ={entry('g', '', '')}"), ("h", "CSQ=a|b")]
    vcf = spark.createDataFrame([(i, "1", 5, "A", "C", x) for i, x in rows], "variant_id string, chrom string, start long, ref string, alt string, info string")
    ids = lambda *a, **k: sorted(r.variant_id or "?" for r in ops.filter_lines(vcf, meta, *a, **k).collect())
    assert ids(5) == ["?", "a", "b", "g"] and ids(5, True) == ["?", "a"] and ids(9, True, True) == ["?", "a", "b"]
    assert ids(5, canonical_only=True) == ["?", "a", "b"]
    assert ops.filter_lines(vcf, meta.limit(0), 5, True).count() == 0
    with pytest.raises(ValueError, match="use filter_variants"):
        ops.filter_lines(vcf, meta, 5, True, max_bytes=10)
    with pytest.raises(ValueError, match="metadata"):
        ops.filter_lines(vcf, None, 5, True)


def _hot_base(spark, n):
    """A third of all rows is one id, a tenth has none."""
    vid = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id") % 500))
    cols = {c: F.lit(None).cast("string") for c in ops.BASE_COLUMNS}
    cols |= {"variant_id": vid, "transcript": F.concat(F.lit("t"), F.col("id") % 40), "gene": F.concat(F.lit("g"), F.col("id") % 7),
             "consequence": F.lit("missense_variant"), "canonical": F.lit(True), "gene_type": F.lit("protein_coding")}
    return spark.range(n).select(*[v.alias(k) for k, v in cols.items()])


def test_a_hot_id_is_spread_and_the_result_is_equal(spark, tmp_out):
    n = 6000
    metrics = sinks.write_parquet(_hot_base(spark, n), tmp_out, metrics={"frequent": ops.frequent_ids()})
    beside = ops.copartition_session(spark)
    base = beside.read.parquet(tmp_out)
    heavy = ops.heavy_ids(beside, metrics["frequent"], 200)
    assert [(r.variant_id, r.salts) for r in heavy.collect()] == [("hot", 10)]
    assert ops.heavy_ids(beside, metrics["frequent"], n) is None
    nmd = spark.createDataFrame([("hot", f"t{k}", k) for k in range(30)] + [("v5", "t5", 1), (None, "t1", 9)], "variant_id string, transcript string, flag int")
    splice = spark.createDataFrame([("hot", f"g{k}", k / 2) for k in range(4)] * 2 + [("v8", "g1", 3.0)], "variant_id string, gene string, s double")
    salted = ops.combine(base, nmd=nmd, splice=splice, copartition=16, heavy=heavy)
    plain = ops.combine(spark.read.parquet(tmp_out), nmd=nmd, splice=splice)
    assert "_salt" not in salted.columns and salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == plain.exceptAll(salted).count() == 0 < plain.count() > n
    spread = salt_rows(base, heavy, "s").groupBy("variant_id", "s").count()
    assert max(r["count"] for r in spread.collect()) <= n / 3 / 10 * 1.5
    assert {r.s for r in spread.filter("variant_id = 'v5'").collect()} == {0}
    with pytest.raises(ValueError, match="copartition layout"):
        ops.combine(base, heavy=heavy)


def test_the_layout_leaves_the_session_alone(spark, fx):
    key = ops.COPARTITION_CONF
    before = spark.conf.get(key, None)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    table = annotation_table(Q._inputs(fx, ("nmd", "absplice")), AnnotationConfig(distance=500))
    assert spark.conf.get(key, None) == before
    assert table.sparkSession.conf.get(key) == "false" and table.sparkSession.conf.get("spark.sql.shuffle.partitions") == "8"
    assert table.count() > 0
    with pytest.raises(ValueError, match="copartition needs"):
        ops.combine(Q._base(fx), copartition=True)


def test_nested_bins_equal_the_range_join(spark):
    points = spark.range(3000).select((F.col("id") % 3).cast("string").alias("chrom"), (F.xxhash64("id") % 1_000_000 + 1_000_000).alias("pos"), "id")
    length = F.when(F.col("k") % 2 == 0, F.pow(F.lit(7.0), F.col("k") % 10)).otherwise(F.col("k") % 3 - 1).cast("long")
    start = F.pmod(F.xxhash64("k"), F.lit(2_000_000))
    spans = spark.range(400).withColumnRenamed("id", "k").select((F.col("k") % 4).cast("string").alias("chrom"), start.alias("start"), (start + length).alias("end"), "k")
    plain = ops.interval_join(points, spans, bin_size=None).select("id", "k")
    for sizes in (ops.NESTED_BINS, (10, 1000), (1 << 30,)):
        nested = ops.interval_join(points, spans, bin_size=sizes)
        assert set(nested.columns) == {"chrom", "pos", "id", "start", "end", "k"}
        nested = nested.select("id", "k")
        assert nested.exceptAll(plain).count() == plain.exceptAll(nested).count() == 0 < plain.count()
    assert ops.interval_join(points, spans.limit(0), bin_size=ops.NESTED_BINS).count() == 0


def test_a_long_interval_is_in_few_bins(spark):
    spans = spark.createDataFrame([("1", 0, 200_000_000), ("1", 16_383, 16_385), ("1", 5, 5), ("1", 7, 3), ("1", 0, 16_384), ("1", 123, 248_956_422)],
                                  "chrom string, start long, end long")
    rows = ops.nested_bins(spans).groupBy("start", "end").count().collect()
    assert {(r.start, r.end): r["count"] for r in rows} == {(0, 200_000_000): 1, (16_383, 16_385): 2, (0, 16_384): 1, (123, 248_956_422): 1}
    with pytest.raises(ValueError, match="inner"):
        ops.interval_join(spans.select("chrom", F.col("start").alias("pos")), spans, bin_size=(10, 100), how="left")


def test_metrics_do_not_multiply_rows(spark, tmp_out):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") % 300).cast("string").alias("b"), (F.col("id") % 2 == 0).alias("f"))
    found = sinks.run_metrics(df, ["a", "b"], ["f"])
    assert "Expand" not in _plan(found)
    assert found.collect()[0].asDict() == {"n_rows": 1000, "distinct_a": 7, "distinct_b": 300, "n_f": 500}


def test_sketches_merge_over_parts(spark, tmp_out):
    paths = []
    for k in range(3):
        path = f"{tmp_out}/{k}"
        rows = spark.range(k * 10_000, k * 10_000 + 20_000).select("id", F.lit(k).alias("k"), F.lit(None).cast("string").alias("none"))
        cols = ["id", "k", "none"]
        sinks.store_metrics(spark, path, sinks.write_parquet(rows, path, metrics=sinks.sketches(cols)), cols)
        paths.append(path)
        assert spark.read.parquet(path).columns == cols  # readers don't see the sketches
    merged = {r.column: r for r in sinks.merged_metrics(spark, paths).collect()}
    assert {r.rows for r in merged.values()} == {60_000}
    assert abs(merged["id"].distinct_estimate / 40_000 - 1) < 0.025 and merged["k"].distinct_estimate == 3 and merged["none"].distinct_estimate == 0
    assert "Expand" not in _plan(sinks.merged_metrics(spark, paths))


def test_frequent_ids_are_merged_in_tasks_not_sent_with_the_write(spark, tmp_out):
    assert not [k for k, c in base_counts().items() if "approx_" in str(c)]
    n = 6000
    _hot_base(spark, n).repartition(80).write.parquet(tmp_out)
    stored = spark.read.parquet(tmp_out).repartition(80)
    counts = {r["item"]: r["count"] for r in ops.stored_frequent_ids(stored)}
    exact = {r["variant_id"]: r["count"] for r in stored.groupBy("variant_id").count().collect()}
    assert counts == exact and counts["hot"] == n / 3 and len(counts) > 400
    assert [(r.variant_id, r.salts) for r in ops.heavy_ids(spark, ops.stored_frequent_ids(stored), 200).collect()] == [("hot", 10)]
    assert list(ops.stored_frequent_ids(stored.limit(0))) == []


def test_many_chunk_folders_are_listed_by_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK_ROWS", 10)
    sc = spark.sparkContext
    sc.setJobGroup("list-chunks", "list-chunks")
    read = Q.QUERIES["chunk_export"](spark, SF_SMALL)
    sc.setLocalProperty("spark.jobGroup.id", None)
    folders, tracker = {f.rsplit("/", 1)[0] for f in read.inputFiles()}, sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("list-chunks") for s in tracker.getJobInfo(j).stageIds]
    assert len(folders) > LISTING_TASKS >= max(s.numTasks for s in stages if s)
    assert read.count() == read.select("variant_id").distinct().count() > 10 * LISTING_TASKS
