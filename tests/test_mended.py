"""Inputs the fixtures never hold, each with literal rows."""

import pytest
from pyspark.sql import functions as F

from vartab import operators as ops
from vartab import sinks, sources
from vartab.plans.config import from_mapping


def _file(spark, path, lines, **options):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.options(**options).text(path)


def test_csv_with_doubled_quotes_and_decimal_starts(spark, tmp_out):
    _file(spark, tmp_out, ["chromosome,note,start_variant,ref,alt,transcript_id,nmd_escape",
                           'chr1,"a ""q"", b",5,A,G,T1,True', "chr1,,7.0,A,G,T2,False", "chr1,,7.5,A,G,T3,False"])
    got = {r.transcript: (r.variant_id, r.nmd_escape) for r in ops.tidy_nmd(sources.read_nmd_csv(spark, tmp_out)).collect()}
    assert got == {"T1": ("chr1_5_A_G", True), "T2": ("chr1_7_A_G", False), "T3": (None, False)}


def test_missing_fields_do_not_shift_lines(spark, tmp_out):
    vcf = spark.createDataFrame([(None, "chr1", 4, "A", "G", "X=1"), ("v", "chr1", 8, "A", "G", None)],
                                "variant_id string, chrom string, start long, ref string, alt string, info string")
    assert [r.value for r in sinks.vcf_lines(vcf).collect()] == ["chr1\t5\t.\tA\tG\t.\t.\tX=1", "chr1\t9\tv\tA\tG\t.\t.\t."]
    gtf = spark.createDataFrame([("chr1", "s", "gene", None, 9, ".", "+", ".", "a")],
                                "seqname string, source string, feature string, start long, end long, score string, "
                                "strand string, frame string, attributes string")
    sinks.sort_annotation(gtf, ["#h"], tmp_out)
    assert sorted(r.value for r in spark.read.text(tmp_out).collect()) == ["#h", "chr1\ts\tgene\t.\t9\t.\t+\t.\ta"]


def test_samples_stay_in_the_line(spark, tmp_out):
    line = "chr1\t5\tv\tA\tG\t.\t.\tCSQ=x\tGT\t0/1\t1/1"
    _file(spark, tmp_out, ["#CHROM", line])
    row = sources.read_vcf(spark, tmp_out, keep_line=True).first()
    assert (row.info, row.line, row.start) == ("CSQ=x", line, 4)


@pytest.mark.parametrize("read", [sources.read_vcf, sources.read_gtf])
def test_unreadable_compression_is_an_error(spark, tmp_out, read):
    import os

    folder = tmp_out.removeprefix("file:")
    os.makedirs(folder)
    with open(folder + "/a.vcf.bgz", "wb") as f:
        f.write(b"\x1f\x8bjunk")
    with pytest.raises(ValueError, match="bgz"):
        read(spark, tmp_out)


def test_compacted_scores_keep_their_chromosome(spark, tmp_out):
    rows = [("1", 5, "A", "G", "g", 0.5, 0.25), ("X", 6, "C", "T", "h", 0.75, 1.0)]
    scores = spark.createDataFrame(rows, "chrom string, start long, ref string, alt string, gene_id string, "
                                         "AbSplice_DNA_max double, AbSplice2_max double")
    sinks.compact_scores(scores, tmp_out)
    back = sources.read_score_files(spark, tmp_out)
    assert sorted(map(tuple, back.select(*scores.columns).collect())) == rows


def test_scores_of_one_name_and_other_key_types(spark):
    v = spark.createDataFrame([("a", "chr1", 5, "A", "G"), ("b", "chr2", 6, "C", "T")],
                              "variant_id string, chrom string, start long, ref string, alt string")
    one = spark.createDataFrame([("1", "5", "A", "G", 0.5)], "chrom string, start string, ref string, alt string, score double")
    two = spark.createDataFrame([(2, 6, "C", "T", 0.25, 7)], "chrom int, start int, ref string, alt string, score double, raw int")
    for size in (None, 1 << 20):
        for prune in (False, True):
            got = ops.lookup_scores(v, {"x": (one, ["score"]), "y": (two, ["score", "raw"])}, strip_chr=True,
                                    broadcast_bytes=size, prune=prune)
            assert got.columns == ["variant_id", "x_score", "y_score", "raw"]
            assert sorted(map(tuple, got.collect()), key=str) == [("a", 0.5, None, None), ("b", None, 0.25, 7)]
    with pytest.raises(ValueError):
        ops.lookup_scores(v, {"x": (one.withColumn("variant_id", F.lit(1)), ["variant_id"])})


def test_two_headers_in_a_folder_of_headerless_parts_is_an_error(spark, tmp_out):
    _file(spark, tmp_out + "/all", ["#Uploaded_variation\tGene\tLoF", "v1\tG1\tHC"])
    frame = lambda x: spark.createDataFrame([(x,)], "value string").coalesce(1).write.mode("append").text(tmp_out + "/all")
    frame("v2\tG2\tLC")
    got = {r.Uploaded_variation: (r.Gene, r.LoF) for r in sources.read_vep_tab(spark, tmp_out + "/all").collect()}
    assert got == {"v1": ("G1", "HC"), "v2": ("G2", "LC")}
    frame("#Uploaded_variation\tLoF\tGene")
    with pytest.raises(ValueError, match="more than one"):
        sources.read_vep_tab(spark, tmp_out + "/all")


def test_chunks_of_a_shuffled_input(spark, tmp_out):
    rows = [(f"v{i}", "chr1", i, "A", "G", "X") for i in range(1000)]
    vcf = spark.createDataFrame(rows, "variant_id string, chrom string, start long, ref string, alt string, info string").repartition(7)
    assert sinks.write_vcf_chunks(vcf, ["#a", "#b"], tmp_out, 60)["rows"] == 1000
    files = spark.read.text(tmp_out).withColumn("f", F.input_file_name()).groupBy("f").agg(F.collect_list("value").alias("v")).collect()
    assert all(r.v[:2] == ["#a", "#b"] and 0 < len(r.v) - 2 <= 60 for r in files)
    assert sorted(x.split("\t")[2] for r in files for x in r.v[2:]) == sorted(r[0] for r in rows)


def test_header_probe_carries_no_data(spark, tmp_out):
    _file(spark, tmp_out, ["##a", "#CHROM"] + ["x" * 1000] * 50 + ["#late"])
    assert sources.read_vcf_header(spark, tmp_out, probe=1) == ["##a", "#CHROM"]
    _file(spark, tmp_out + "2", ["##only"])
    assert sources.read_vcf_header(spark, tmp_out + "2") == ["##only"]


def test_parts_of_two_schemas(spark, tmp_out):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(tmp_out + "/a")
    spark.createDataFrame([(2, 0.5)], "x int, z double").write.parquet(tmp_out + "/b")
    spark.createDataFrame([(3,)], "x long").write.parquet(tmp_out + "/c")
    two = sources.read_parts(spark, [tmp_out + "/a", tmp_out + "/b"])
    assert sorted(map(tuple, two.select("x", "y", "z").collect())) == [(1, "a", None), (2, None, 0.5)]
    assert sorted(r.x for r in sources.read_parts(spark, [tmp_out + "/a", tmp_out + "/c"]).collect()) == [1, 3]


def test_exon_numbers_without_the_attribute(spark):
    gtf = spark.createDataFrame([("chr1", "exon", 11, 20, "-", 'transcript_id "t";'), ("chr1", "exon", 31, 40, "-", 'transcript_id "t";'),
                                 ("chr1", "exon", 1, 5, "+", 'transcript_id "u"; exon_number "7";')],
                                "seqname string, feature string, start long, end long, strand string, attributes string")
    got = sorted(map(tuple, ops.exons_from_gtf(gtf).collect()))
    assert got == [("t", "chr1", 1, 2, 30, 40), ("t", "chr1", 2, 2, 10, 20), ("u", "chr1", 7, 1, 0, 5)]


@pytest.mark.parametrize("extra", [{"distanse": 5}, {"fastvep": {"canonicalonly": True}}, {"additional": {"e2g": {"treshold": 1}}},
                                   {"additional": {"scores": {"a": {"path": "p", "columns": ["x"], "y": 1}}}}])
def test_unknown_configuration_keys(extra):
    with pytest.raises(ValueError, match="unknown"):
        from_mapping({"input_vcf": "a", "gtf": "b", "output_dir": "c", **extra})


def test_configuration_needs_its_paths():
    from vartab.plans.annotation import AnnotationConfig, E2GConfig

    with pytest.raises(ValueError, match="gtf, output_dir, e2g.predictions"):
        AnnotationConfig(input_vcf="a", e2g=E2GConfig(enhancers="e")).validate(files=True)
    scores = from_mapping({"input_vcf": "a", "gtf": "b", "output_dir": "c", "additional": {
        "scores": {"cadd": {"path": "p", "columns": ["x"]}}}}).score_tables
    assert scores["cadd"].path == "p" and scores["cadd"].columns == ["x"]


def test_pruning_keeps_every_chromosome_that_meets(spark, monkeypatch):
    """A null among the names does not hide that there are too many, and every
    name that strips to a site's is read."""
    from vartab.operators import scores as s

    monkeypatch.setattr(s, "_MOST_CHROMOSOMES", 2)
    table = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "chrom string")
    sites = spark.createDataFrame([(None,), ("a",), ("b",), ("c",)], "chrom string")
    # whichever three of the four names the limit takes
    for order in ([0, 1, 2, 3], [1, 2, 0, 3], [3, 2, 0, 1]):
        rows = sites.collect()
        given = spark.createDataFrame([rows[i] for i in order], "chrom string").coalesce(1)
        assert s.on_chromosomes_of(table, given).count() == 4
    two = sites.filter("chrom IS NULL OR chrom < 'c'")
    assert {r.chrom for r in s.on_chromosomes_of(table, two).collect()} == {"a", "b"}
    odd = spark.createDataFrame([("Un_chr1",), ("chr2",), ("2",), ("3",)], "chrom string")
    wanted = spark.createDataFrame([("Un_1",), ("chr2",)], "chrom string")
    assert {r.chrom for r in s.on_chromosomes_of(odd, wanted, strip_chr=True).collect()} == {"Un_chr1", "chr2", "2"}
