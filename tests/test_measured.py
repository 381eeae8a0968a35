"""Inputs and joins that hold at size: sides are broadcast for their measured bytes, and
the derived inputs are the rows of their SQL text, however they are built."""

import pytest

from conftest import SF_SMALL
from vartab.plans import fixtures as fixtures_module
from vartab.plans.fixtures import FIXTURE_SQL, SPARK_SQL, Fixtures
from vartab.session import measured_session


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _odd_tables(spark, path):
    """Parts and line items with nulls, equal rows and several rows of one key."""
    parts = [(1, "PROMO", 3), (1, "PROMO", 3), (2, None, 4), (3, "SMALL", None), (None, "SMALL", 5), (4, "ECONOMY", 8), (6, "PROMO", 2)]
    lines = [(o, p, n, f, s) for p in (1, 2, 3, 4, 5, None) for o, n, f, s in
             ((7, 1, "A", "O"), (7, 1, "A", "O"), (9, 5, "N", "F"), (1500, 7, "R", "F"), (2400, 2, None, None), (None, 4, "A", "O"), (11, None, "A", "F"))]
    lines += [(7 + 2600, 1, 3, "A", "O")]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_size int").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("name", sorted(SPARK_SQL))
def test_other_text_gives_the_same_rows(spark, tmp_out, monkeypatch, name, odd):
    path = _odd_tables(spark, tmp_out) if odd else SF_SMALL
    new = Fixtures(spark, path)[name].collect()
    monkeypatch.setattr(fixtures_module, "SPARK_SQL", {})
    old = Fixtures(spark, path)[name].collect()
    assert sorted(map(repr, new)) == sorted(map(repr, old)) and len(new) > 20


def test_a_side_is_not_broadcast_for_its_packed_files(spark):
    fx = Fixtures(spark, SF_SMALL)
    for name in ("fx_csq", "fx_vep", "fx_nmd", "fx_splice"):
        assert "Broadcast" not in _plan(fx[name]), name
    assert set(SPARK_SQL) <= set(FIXTURE_SQL)


def test_measured_session_keeps_the_callers_settings(spark):
    auto, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(auto)
    twice = measured_session(measured_session(spark))
    assert twice.conf.get(auto) == "-1" and twice.conf.get(adaptive) == before == spark.conf.get(auto)
    assert twice.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_blocks_are_written_and_read_in_sessions_beside_one_another(spark, tmp_out):
    from vartab import sinks, sources

    for k, own in enumerate((measured_session(spark), spark, measured_session(spark), measured_session(spark))):
        path = f"{tmp_out}-{k}"
        sinks.write_text(own.range(50, numPartitions=5).selectExpr("'l' || id AS value"), ["#h"], path, compression="blocks")
        for reader in (own, spark):
            assert sources.read_blocks(reader, path).count() == 51


def test_ranges_are_bounded_in_number(spark, tmp_out, monkeypatch):
    from vartab.sources import blocks

    blocks.write_blocks(spark.range(20_000, numPartitions=3).selectExpr("sha2(string(id), 256) AS value"), tmp_out)
    sizes = lambda: len(blocks._Reader({"path": tmp_out, "splitbytes": "64"}).partitions())
    monkeypatch.setattr(blocks, "MOST_RANGES", 10)
    assert 10 <= sizes() <= 13


def test_links_dealt_by_variant_are_the_same_and_stay(spark):
    from pyspark.sql import functions as F

    from vartab import operators as ops
    from vartab.plans import inputs as I
    from vartab.plans import queries as Q

    fx = Fixtures(spark, SF_SMALL)
    gmap = ops.gene_version_map(I.gtf_gene_rows(fx))
    by_gene = gmap.unionByName(gmap.limit(3).withColumn("gene_id", F.concat("gene_id", F.lit("x"))))
    whole = lambda by: ops.enhancer_links(fx.fx_variant, fx.fx_prediction, fx.fx_enhancer, by_gene, classes=Q.E2G_CLASSES, by_variant=by)
    plain = ops.map_gene_versions(Q._e2g(fx, fx.fx_variant).limit(0), gmap, "target_gene_id").columns
    assert whole(True).columns == plain and sorted(map(repr, whole(True).collect())) == sorted(map(repr, whole(False).collect()))
    plan = _plan(Q.q_combine_e2g(spark, SF_SMALL))
    assert plan.count("hashpartitioning(variant_id") == 2, plan  # the links and the base, each dealt once


def test_a_large_gene_model_is_not_broadcast(spark):
    from vartab.operators import joins
    from vartab.plans import queries as Q

    assert joins.BROADCAST_MAX_BYTES <= 64 << 20
    fx = Fixtures(spark, SF_SMALL)
    plan = _plan(Q.q_base_table_shuffled(spark, SF_SMALL))
    assert "ShuffledHashJoin" in plan and "Sort [transcript" not in plan


def test_a_tasks_share_is_bounded_and_partitions_grow_with_the_input(spark):
    from vartab import session as S

    own = measured_session(spark)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        assert int(own.conf.get(key)) <= 16 << 20
        beside = S.session_beside(spark, {key: "1m"})
        assert int(measured_session(beside).conf.get(key)) == 1 << 20  # a smaller one stays
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = S.shuffle_partitions(own, 0)
    S.grow_partitions(own, 100 << 20)
    assert own.conf.get(key) == "100" and least == 8
    S.grow_partitions(own, 1)
    S.grow_partitions(own, 1 << 50)
    assert own.conf.get(key) == str(S.MOST_PARTITIONS) and spark.conf.get(key, None) is None
    assert S.planned_bytes(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"), spark.read.parquet(f"{SF_SMALL}/part.parquet")) > 10_000


def test_entries_with_a_gene(spark):
    from vartab import operators as ops
    from vartab.operators.consequence import gene_entries

    texts = ["g", "", "-", "-x", "--", "g|", "-|", "|", "|-", "\n", "-\n", " -"]
    infos = [f"X;CSQ=a|b|c|d|{t},a|b|c|d|{u}|T;Y" for t in texts for u in texts] + ["CSQ=a|b|c", "CSQ=", "", None, "X=1", "CSQ=a|b\n|c|d|e,", "CSQ=,,;CSQ=a|b|c|d|e"]
    vcf = spark.createDataFrame([(str(k), "1", k, "A", "C", x) for k, x in enumerate(infos)], "variant_id string, chrom string, start long, ref string, alt string, info string")
    found = sorted((r.variant_id, r.p) for r in ops.csq_entries(vcf).collect())
    plain = sorted((r.variant_id, p) for r in vcf.select("variant_id", gene_entries("info").alias("a")).collect() for p in r.a or [])
    assert found == plain and len(found) > 150
    assert "lambdafunction" not in _plan(ops.csq_entries(vcf))


def _odd_links(spark, ids):
    variants = spark.createDataFrame(ids, "variant_id string, chrom string, start long")
    pairs = spark.createDataFrame([(1, g, f"S{g}", (g or 3) * 900, s, 2, "1", a, b, c) for g, s, a, b, c in
                                   ((1, .7, 0, 30_000, "genic"), (1, .9, 9_000, 25_000, "intergenic"), (2, .6, 5, 6, None), (None, .8, 0, 50_000, "genic"))],
                                  "enhancer_id int, target_gene_id int, target_gene_name string, target_gene_tss long, score double, n_cell_types int, chrom string, start long, end long, class string")
    return variants, pairs


_NAMED = [(f"{c}_{p}_A_C", c, p) for c in ("chr1", "1") for p in (5, 9_999, 10_000, 29_999, 60_000)]


@pytest.mark.parametrize("more, local", [([], True), (_NAMED[:3], True), ([("chr1_77_A_C", None, 77), (None, "1", None)], True),
                                         ([("rs1", "1", 5), ("rs1", "1", 20_000)], False), ([(None, "1", 5), (None, "1", 20_000)], False),
                                         ([("un_x_5_A", "un_x", 5)], False)])
def test_links_are_grouped_where_they_are_made(spark, more, local):
    from vartab import operators as ops

    variants, pairs = _odd_links(spark, _NAMED + more)
    n = ops.local_partitions(variants)
    assert (n == 1) if local else n is None
    found, plain = (ops.variant_gene_links(ops.enhancer_hits(variants, pairs, partitions=k)) for k in (n, None))
    assert found.columns == plain.columns and sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect())) and plain.count() > 8
    assert ("hashpartitioning(variant_id" in _plan(found)) != local


def test_a_full_bin_is_not_grouped_in_one_task(spark, monkeypatch):
    from vartab import operators as ops
    from vartab.operators import enhancers

    variants = spark.range(40).selectExpr("'1_' || id || '_A_C' AS variant_id", "'1' AS chrom", "id AS start")
    monkeypatch.setattr(enhancers, "TASK_VARIANTS", 15)
    assert ops.local_partitions(variants) == 3
    monkeypatch.setattr(enhancers, "BIN_VARIANTS", 39)
    assert ops.local_partitions(variants) is None and ops.local_partitions(variants.limit(0)) is None


def test_a_point_meets_only_intervals_that_reach_its_part(spark):
    from pyspark.sql import functions as F
    from vartab import operators as ops
    from vartab.operators import interval

    spans = spark.createDataFrame([("1", 0, 10_000_000), ("1", 5, 9), ("1", 30_000_000, 30_200_000), ("1", 66_000_000, 68_000_000), ("1", 7, 7)], "chrom string, start long, end long")
    parts = interval._with_parts(ops.nested_bins(spans, bin_col="_ibin", level_col="_ilevel"), "start", "end", ops.NESTED_BINS)
    copies = {r.start: r["count"] for r in parts.groupBy("start").count().collect()}
    assert copies == {0: 2, 5: 1, 30_000_000: 3, 66_000_000: 3}, copies
    points = spark.range(0, 70_000_000, 50_000).select(F.lit("1").alias("chrom"), F.col("id").alias("pos"))
    plan = _plan(ops.interval_join(points, spans, bin_size=ops.NESTED_BINS))
    assert "_ipart" in plan
    nested, plain = (ops.interval_join(points, spans, bin_size=b).select("pos", "start") for b in (ops.NESTED_BINS, None))
    assert nested.exceptAll(plain).count() == plain.exceptAll(nested).count() == 0 < plain.count()
