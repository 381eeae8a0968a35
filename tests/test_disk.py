"""What a run holds on disk: shuffles are gone once a step is stored, the base is joined
in passes, and what is only read in between is deleted."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vartab import operators as ops
from vartab import sinks, sources
from vartab.plans import annotation
from vartab.plans import inputs as I
from vartab.plans import queries as Q
from vartab.plans.fixtures import Fixtures
from vartab.session import CLEANUP_CONF, ensure_checkpoint_dir, measured_session, shuffles_dropped


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def _work(spark, label):
    return set(glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:") + f"/vartab-{label}-*"))


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_SMALL)


@pytest.mark.parametrize("write", [
    lambda df, path: sinks.write_parquet(df, path),
    lambda df, path: sinks.write_annotations(df, path, ["k"]),
    lambda df, path: sinks.write_ids(df, path),
    lambda df, path: sinks.write_text(df, ["#h"], path),
    lambda df, path: sinks.distinct_counts(df, ["value"]),
    lambda df, path: ops.joins.measured_bytes(df)], ids=["parquet", "annotations", "ids", "text", "distinct", "measured"])
def test_a_stored_step_leaves_no_shuffle_files(spark, tmp_out, write):
    df = spark.range(3000).select(F.col("id").cast("string").alias("value"), (F.col("id") % 3).alias("k")).repartition("value")
    before = _shuffle_files(spark)
    write(df, tmp_out)
    for _ in range(50):  # files are deleted beside
        left = {f for f in _shuffle_files(spark) - before if f.endswith(".data")}
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_the_callers_setting_is_put_back(spark):
    own = measured_session(spark)
    before = own.conf.get(CLEANUP_CONF, None)
    with pytest.raises(KeyError), shuffles_dropped(own):
        assert own.conf.get(CLEANUP_CONF) == "true"
        raise KeyError
    assert own.conf.get(CLEANUP_CONF, None) == before


TOOLS = ("vep", "nmd", "e2g", "absplice")


@pytest.mark.parametrize("tools, more", [(TOOLS, {}), (TOOLS, {"canonical_only": True, "protein_coding_only": True, "rows_per_salt": 4}), (("e2g",), {}), ((), {})],
                         ids=["all", "salted", "e2g", "none"])
def test_passes_give_the_same_rows_and_leave_one_table(spark, monkeypatch, tools, more):
    whole = Q._combine(spark, SF_SMALL, tools, **more)
    monkeypatch.setattr(annotation, "PASS_BYTES", 1)
    labels = ("base", "sites", "e2g", "absplice", "combined")
    before = {w: _work(spark, w) for w in labels}
    found = Q._combine(spark, SF_SMALL, tools, **more)
    made = {w: len(_work(spark, w) - before[w]) for w in labels}
    assert made == dict.fromkeys(labels, 0) | ({"combined": 1} if tools else {"base": 1})
    assert found.columns == whole.columns and _rows(found) == _rows(whole) and whole.count() > 100
    if tools:
        assert "Exchange" not in _plan(found)


def test_ids_of_a_pass_are_whole_and_missing_ones_are_kept(spark, monkeypatch, tmp_out):
    cols = {c: F.lit(None).cast("string") for c in ops.BASE_COLUMNS}
    cols |= {"variant_id": F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), F.col("id") % 30)), "transcript": F.concat(F.lit("t"), F.col("id") % 4), "gene": F.lit("g")}
    spark.range(200).select(*[v.alias(k) for k, v in cols.items()]).write.parquet(tmp_out)
    nmd = spark.createDataFrame([(f"v{k}", f"t{k % 4}", k) for k in range(30)] * 2 + [(None, "t1", 9)], "variant_id string, transcript string, flag int")
    base = ops.copartition_session(spark).read.parquet(tmp_out)
    whole = annotation.annotation_table(None, annotation.AnnotationConfig(), base, {"nmd": nmd}, True)
    monkeypatch.setattr(annotation, "PASS_BYTES", 1)
    passes, _ = annotation._frames(None, annotation.AnnotationConfig(), base, {"nmd": nmd}, True)
    ids = [{r.variant_id for r in f.select("variant_id").distinct().collect()} for f in passes]
    assert len(passes) == annotation.MOST_PASSES and sum(map(len, ids)) == len(set.union(*ids)) == 25
    found = annotation.annotation_table(None, annotation.AnnotationConfig(), base, {"nmd": nmd}, True)
    assert _rows(found) == _rows(whole) and whole.filter("variant_id IS NULL").count() == 40


def test_passes_are_for_the_rows_that_the_toggles_leave(spark, fx, monkeypatch, tmp_out):
    Q._base(fx).write.parquet(tmp_out)
    base = spark.read.parquet(tmp_out)
    size = annotation.planned_bytes(base)
    monkeypatch.setattr(annotation, "PASS_BYTES", size // 3)
    passes = [annotation._passes(base, annotation.AnnotationConfig(canonical_only=c)) for c in (False, True)]
    share = base.filter("canonical").count() / base.count()
    assert passes[0] == 4 and passes[1] == max(1, min(4, -(-int(size * share) // (size // 3)))) < 4
    monkeypatch.setattr(annotation, "PASS_BYTES", size)
    assert annotation._passes(base, annotation.AnnotationConfig()) == 1


@pytest.mark.parametrize("name", ["read_annotations", "overwrite_drops_stale"])
def test_a_table_written_in_passes_is_the_same(spark, monkeypatch, name):
    whole, before = Q.QUERIES[name](spark, SF_SMALL), _work(spark, "base")
    monkeypatch.setattr(annotation, "PASS_BYTES", 1)
    found = Q.QUERIES[name](spark, SF_SMALL)
    assert not _work(spark, "base") - before
    assert found.columns == whole.columns and _rows(found) == _rows(whole) and whole.count() > 100


def test_without_a_part_the_base_is_not_dealt(spark, fx, tmp_out):
    Q._base(fx).write.parquet(tmp_out)
    base = ops.copartition_session(spark).read.parquet(tmp_out)
    heavy = ops.heavy_ids(spark, [("x", 9)], 2)
    for given in ({}, {"heavy": heavy}):
        table = ops.combine(base, copartition=True, canonical_only=True, **given)
        assert "Exchange" not in _plan(table) and table.count() == base.filter("canonical").count()
        assert "_salt" not in table.columns


ODD = ["chr1", None, "a\tb", "", "|", "=", "\n", "chr 1"]


def test_packed_rows_are_those_of_the_columns(spark, fx):
    entry = "A|x&y|HIGH|S|{g}|Transcript|{t}|pc|1/3||h||c|d|e|f|g|||{d}|-1{more}"
    entries = [entry.format(g=g, t=t, d=d, more=m) for g, t, d in (("g1", "t1", ""), ("", "t2", "7"), ("g2", "", "12"), ("g3", "t9", "")) for m in ("", "||||||||||||ENSP1", "||||||||||||E|more|", "|" * 20)]
    entries += ["A|c|d|e|g1", "A|c|d|e|g1|f|t1", "|||||", "A|c|d|e|-|f|t1", "A|c|d|e"]
    keys = [(a, b, n, c, d) for a, b in zip(ODD, reversed(ODD)) for c, d in (("A", "G"), ("AT", None), (None, "\t"), ("N", "<DEL>")) for n in (0, 5, None, -3)]
    vcf = spark.createDataFrame([(*k, "X;CSQ=" + ",".join(entries)) for k in keys] + [("v", "1", 1, "A", "C", None)],
                                "variant_id string, chrom string, start long, ref string, alt string, info string")
    meta = spark.createDataFrame([(f"t{k}", f"s{k}", "pc", None, k == 1, k) for k in (1, 1, 2)] + [("", "none", "x", "y", True, None)],
                                 "transcript_id string, symbol string, gene_type string, biotype string, canonical boolean, tsl int")
    for sv in (None, vcf):
        plain, packed = (ops.base_table(vcf, sv, meta, broadcast_bytes=b) for b in (1 << 20, None))
        assert packed.columns == plain.columns == ops.BASE_COLUMNS and packed.dtypes == plain.dtypes
        assert _rows(packed) == _rows(plain) and plain.count() > 2000
    row = [line for line in _plan(packed).splitlines() if "Exchange hashpartitioning(transcript" in line]
    assert row and "_packed" in _plan(packed)


def test_chunks_may_be_packed_and_are_read_alike(spark, fx, tmp_out):
    vcf = I.vcf_rows(fx)
    for kind in (None, "gzip"):
        path = f"{tmp_out}-{kind}"
        assert sinks.write_vcf_chunks(vcf, I.VCF_HEADER, path, 300, compression=kind)["rows"] == vcf.count()
        files = glob.glob(path.removeprefix("file:") + "/chunk=*/part-*")
        assert files and all(f.endswith(".gz") == (kind == "gzip") for f in files)
        assert _rows(sources.read_vcf(spark, path).select(vcf.columns)) == _rows(vcf)
    assert all(f.endswith(".gz") for f in Q.QUERIES["chunk_export"](spark, SF_SMALL).inputFiles())


def test_staged_rows_are_written_alike_and_deleted(spark, fx, tmp_out):
    vcf = I.vcf_rows(fx).repartition(5, "variant_id")
    for staged in (False, True):
        assert sinks.write_vcf(vcf, I.VCF_HEADER, f"{tmp_out}-{staged}", staged=staged)["rows"] == vcf.count()
    plain, found = (sources.read_vcf(spark, f"{tmp_out}-{s}") for s in (False, True))
    assert _rows(found) == _rows(plain) and not _work(spark, "vcf-rows")


def test_the_payload_alone_stores_no_variants(spark):
    own = Fixtures(spark, SF_SMALL, materialize=True)
    payload, plain = own.fx_csq, Fixtures(spark, SF_SMALL)
    assert len(_work(spark, "fixtures")) and not glob.glob(own._folder.removeprefix("file:") + "/fx_variant")
    assert _rows(payload) == _rows(plain.fx_csq)
    assert _rows(own.fx_variant) == _rows(plain.fx_variant)
    assert glob.glob(own._folder.removeprefix("file:") + "/fx_variant")
