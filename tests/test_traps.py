
import glob

import pytest
from pyspark.sql import functions as F

from vartab import operators as ops
from vartab import sinks, sources
from vartab.functions import key_parts, onehot_columns, variant_key

VCF_COLS = "variant_id string, chrom string, start bigint, ref string, alt string, info string"


def _entry(n_fields, **vals):
    p = [""] * n_fields
    for pos, v in vals.items():
        p[int(pos[1:]) - 1] = v
    return "|".join(p)


def test_t1_short_csq_entry_gives_null_not_error(spark):
    e = _entry(22, f2="missense_variant", f5="G1", f7="T1", f21="5", f22="1")
    vcf = spark.createDataFrame([("v1", "chr1", 10, "A", "G", f"CSQ={e}")], VCF_COLS)
    r = ops.explode_csq(vcf).collect()
    assert len(r) == 1 and r[0]["ensp"] is None and r[0]["distance"] == 5 and r[0]["strand"] == 1


def test_t2_strict_int_cast(spark):
    ok = _entry(33, f5="G1", f7="T1", f21="")
    bad = _entry(33, f5="G1", f7="T1", f21="1.5")
    vcf = spark.createDataFrame([("v1", "chr1", 10, "A", "G", f"CSQ={ok}")], VCF_COLS)
    assert ops.explode_csq(vcf).collect()[0]["distance"] is None
    vcf_bad = spark.createDataFrame([("v1", "chr1", 10, "A", "G", f"CSQ={bad}")], VCF_COLS)
    with pytest.raises(Exception):
        ops.explode_csq(vcf_bad).collect()


def test_t3_trailing_empty_fields_survive(spark):
    e = _entry(33, f5="G1", f7="T1", f33="ENSP9")
    assert e.endswith("|ENSP9")
    vcf = spark.createDataFrame([("v1", "chr1", 10, "A", "G", f"X=1;CSQ={e};Y=2")], VCF_COLS)
    assert ops.explode_csq(vcf).collect()[0]["ensp"] == "ENSP9"


def test_flt1_flt2_no_csq_and_intergenic_dropped(spark):
    inter = _entry(33, f5="-", f7="T1")
    missing_gene = "a|b"
    vcf = spark.createDataFrame([("v1", "chr1", 1, "A", "G", "AC=1"),
                                 ("v2", "chr1", 2, "A", "G", f"CSQ={inter},{missing_gene}")],
                                VCF_COLS)
    assert ops.explode_csq(vcf).count() == 0


def test_t4_missing_attribute_is_null(spark):
    gtf = spark.createDataFrame([('transcript_id "T1"; gene_id "G1";',)], "attributes string")
    r = ops.transcript_metadata(gtf).collect()[0]
    assert r["symbol"] is None and r["tsl"] is None and r["appris"] is None
    assert r["canonical"] is False and r["mane_select"] is False


def test_t5_literal_match_and_null_rules(spark):
    df = spark.createDataFrame([("stopXgained",), (None,), ("stop_gained&intron_variant",)],
                               "c string")
    base = df.select(*onehot_columns("c", null_as_zero=True)).collect()
    vep = df.select(*onehot_columns("c", null_as_zero=False)).collect()
    assert [r["Consequence_stop_gained"] for r in base] == [0, 0, 1]
    assert [r["Consequence_stop_gained"] for r in vep] == [0, None, 1]
    assert [r["Consequence_intron_variant"] for r in base] == [0, 0, 1]


def test_t6_key_build_null_part(spark):
    df = spark.createDataFrame([("chr1", 5, "A", None), ("chr1", 5, "A", "T")],
                               "c string, s bigint, r string, a string")
    out = [r[0] for r in df.select(variant_key("c", "s", "r", "a")).collect()]
    assert out == [None, "chr1_5_A_T"]


def test_t7_everything_not_1x1_is_indel(spark):
    rows = [("v1", "chr1", 1, "A", "G"), ("v2", "chr1", 1, "AT", "GC"),
            ("v3", "chr1", 1, "A", "T,C"), ("v4", "chr1", 1, None, "T")]
    e = _entry(33, f5="G", f7="T")
    vcf = spark.createDataFrame([r + (f"CSQ={e}",) for r in rows], VCF_COLS)
    got = {r["variant_id"]: r["variant_type"] for r in ops.explode_csq(vcf).collect()}
    assert got == {"v1": "SNV", "v2": "indel", "v3": "indel", "v4": "indel"}


def test_t8_empty_interval_touches_no_bin(spark):
    iv = spark.createDataFrame([(1, "1", 10, 10), (2, "1", 20, 5), (3, "1", 9999, 10001)],
                               "id int, chrom string, start bigint, end bigint")
    bins = sorted((r["id"], r["bin"]) for r in ops.interval_bins(iv).collect())
    assert bins == [(3, 0), (3, 1)]
    pts = spark.createDataFrame([("a", "1", 10)], "variant_id string, chrom string, pos bigint")
    assert ops.interval_join(pts, iv.withColumnRenamed("id", "iid")).count() == 0


def test_t9_hive_round_trip_types(spark, tmp_out):
    df = spark.createDataFrame([("v1", "SNV", "protein_coding", True),
                                ("v2", "SNV", None, False), ("v3", "SV", "lncRNA", None)],
                               "variant_id string, variant_type string, gene_type string, "
                               "canonical boolean")
    sinks.write_annotations(df, tmp_out)
    back = sources.read_annotations(spark, tmp_out)
    assert dict(back.dtypes)["canonical"] == "boolean"
    got = {r["variant_id"]: (r["gene_type"], r["canonical"]) for r in back.collect()}
    assert got == {"v1": ("protein_coding", True), "v2": (None, False), "v3": ("lncRNA", None)}


def _hits(spark, rows):
    return spark.createDataFrame(rows, "variant_id string, target_gene_id string, "
                                       "target_gene_name string, score double, vstart bigint, "
                                       "target_gene_tss bigint, class string, n_cell_types long")


def test_t10_class_pick_is_deterministic(spark):
    h = _hits(spark, [("v", "G", "S", 0.6, 100, 50, "intergenic", 2),
                      ("v", "G", "S", 0.9, 100, 160, "genic", 3)])
    r = ops.variant_gene_links(h).collect()[0]
    assert (r["enhancer_class"], r["e2g_score"], r["distance_to_tss"], r["n_cell_types"]) == \
        ("genic", 0.9, 50, 3)


def test_t12_conflicting_names_stay_separate(spark):
    h = _hits(spark, [("v", "G", "S1", 0.6, 1, 1, "genic", 1),
                      ("v", "G", "S2", 0.7, 1, 1, "genic", 1)])
    assert ops.variant_gene_links(h).count() == 2


def test_t11_par_y_twins(spark):
    genes = spark.createDataFrame([('gene_id "ENSG1.5";',), ('gene_id "ENSG1.5_PAR_Y";',),
                                   ('gene_id "ENSG2.1";',)], "attributes string")
    one = {r["gene_id_unversioned"]: r["gene_id"] for r in ops.gene_version_map(genes).collect()}
    assert one == {"ENSG1": "ENSG1.5", "ENSG2": "ENSG2.1"}
    pairs = ops.gene_version_map(genes, fan_out=True)
    assert pairs.count() == 3
    scores = spark.createDataFrame([("chr1", 10, "A", "G", "ENSG1", 0.1, 0.2),
                                    ("chr1", 11, "A", "G", "ENSG9", 0.3, 0.4)],
                                   "chrom string, start bigint, ref string, alt string, "
                                   "gene_id string, AbSplice_DNA_max double, AbSplice2_max double")
    v = spark.createDataFrame([("a", "chr1", 10, "A", "G"), ("b", "chr1", 11, "A", "G")],
                              "variant_id string, chrom string, start bigint, ref string, alt string")
    got = sorted((r["variant_id"], r["gene"]) for r in ops.splice_lookup(v, scores, pairs).collect())
    assert got == [("a", "ENSG1.5"), ("a", "ENSG1.5_PAR_Y"), ("b", "ENSG9")]


BASE_SCHEMA = ("variant_id string, chrom string, start bigint, ref string, alt string, "
               "variant_type string, gene string, transcript string, consequence string, "
               "gene_type string, canonical boolean, distance int")


def _base(spark, rows):
    return spark.createDataFrame(rows, BASE_SCHEMA)


def test_t13_t14_prefix_and_fan_out(spark):
    base = _base(spark, [("v", "chr1", 1, "A", "G", "SNV", "G1", "T1", "x", "protein_coding",
                          True, None)])
    e2g = spark.createDataFrame([("v", "G1", "S", 0.7), ("v", "G1", "S2", 0.8)],
                                "variant_id string, target_gene_id string, "
                                "target_gene_name string, e2g_score double")
    out = ops.combine(base, e2g=e2g)
    assert "e2g_e2g_score" in out.columns and "e2g_target_gene_name" in out.columns
    assert out.count() == 2
    assert ops.repeated_keys(e2g, ["variant_id", "target_gene_id"]).count() == 1


def test_t15_t16_toggles_drop_metadata_miss_and_sv(spark):
    base = _base(spark, [
        ("v1", "chr1", 1, "A", "G", "SNV", "G1", "T1", "x", "protein_coding", True, None),
        ("v2", "chr1", 1, "A", "G", "SNV", "G1", "T9", "x", None, None, None),
        ("s1", "chr1", 1, "N", "<DEL>", "SV", "G1", "T2", "x", "lncRNA", True, None),
        ("s2", "chr1", 1, "N", "<DEL>", "SV", "G1", "T1", "x", "protein_coding", True, None)])
    out = ops.combine(base, protein_coding_only=True, canonical_only=True)
    assert sorted(r["variant_id"] for r in out.collect()) == ["s2", "v1"]
    assert ops.combine(base).count() == 4


def test_t18_gz_is_one_split_then_repartitioned(spark, tmp_out):
    rows = spark.range(2000).select(
        F.lit("chr1").alias("chrom"), (F.col("id") + 1).alias("start"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("variant_id"),
        F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.lit("CSQ=").alias("info"))
    sinks.write_vcf(rows.coalesce(1), ["##fileformat=VCFv4.2"], tmp_out, sort=False)
    assert sources.read_vcf(spark, tmp_out, partitions=4).rdd.getNumPartitions() == 4
    assert sources.read_vcf(spark, tmp_out).count() == 2000


def test_t19_hash_inside_a_line_is_data(spark, tmp_out):
    lines = spark.createDataFrame([("chr1\t5\tv1\tA\tG\t.\t.\tNOTE=a#b",)], "value string")
    sinks.write_text(lines, ["##x", "#CHROM\tPOS"], tmp_out)
    r = sources.read_vcf(spark, tmp_out).collect()
    assert len(r) == 1 and r[0]["info"] == "NOTE=a#b" and r[0]["start"] == 4


def test_t20_key_split_keeps_rest_in_alt(spark):
    df = spark.createDataFrame([("chr1_100_A_T_X",), ("chr1_x_A_T",)], "k string")
    k = key_parts("k")
    rows = df.select(*[k[c].alias(c) for c in ("chrom", "start", "ref", "alt")]).collect()
    assert tuple(rows[0]) == ("chr1", 100, "A", "T_X")
    assert rows[1]["start"] is None


def test_t21_tsl_text_is_null(spark):
    gtf = spark.createDataFrame([('transcript_id "T1"; gene_id "G"; transcript_support_level "1 (assigned)";',),
                                 ('transcript_id "T2"; gene_id "G"; transcript_support_level "NA";',),
                                 ('transcript_id "T3"; gene_id "G"; transcript_support_level "3";',)],
                                "attributes string")
    got = {r["transcript_id"]: r["tsl"] for r in ops.transcript_metadata(gtf).collect()}
    assert got == {"T1": None, "T2": None, "T3": 3}


def test_t23_splice_chrom_compared_as_given(spark):
    scores = spark.createDataFrame([("1", 10, "A", "G", "ENSG1", 0.1, 0.2)],
                                   "chrom string, start bigint, ref string, alt string, "
                                   "gene_id string, AbSplice_DNA_max double, AbSplice2_max double")
    v = spark.createDataFrame([("a", "chr1", 10, "A", "G")],
                              "variant_id string, chrom string, start bigint, ref string, alt string")
    pairs = spark.createDataFrame([], "gene_id string, gene_id_unversioned string")
    assert ops.splice_lookup(v, scores, pairs).count() == 0
    assert ops.splice_lookup(v, scores, pairs, strip_chr=True).count() == 1


def test_canonical_rule_mane_then_principal_then_id(spark):
    gtf = spark.createDataFrame([
        ('transcript_id "T3"; gene_id "G1"; tag "appris_principal_1";',),
        ('transcript_id "T2"; gene_id "G1"; tag "appris_principal_1";',),
        ('transcript_id "T9"; gene_id "G1"; tag "MANE_Select";',),
        ('transcript_id "T4"; gene_id "G2"; tag "appris_principal_3";',),
        ('transcript_id "T5"; gene_id "G2"; tag "appris_principal_2";',),
        ('transcript_id "T6"; gene_id "G3"; tag "appris_alternative_1";',)], "attributes string")
    got = {r["transcript_id"]: r["canonical"] for r in ops.transcript_metadata(gtf).collect()}
    assert got == {"T3": False, "T2": False, "T9": True, "T4": False, "T5": True, "T6": False}


def test_vep_tab_ragged_lines_and_tokens(spark, tmp_out):
    lines = spark.createDataFrame([("v_1_A_G\tG1\t-\textra",), ("v_2_A_G\t\t",), ("v_3_A_G",)],
                                  "value string")
    sinks.write_text(lines, ["## VEP", "#Uploaded_variation\tGene\tFeature"], tmp_out)
    got = sorted(tuple(r) for r in sources.read_vep_tab(spark, tmp_out).collect())
    assert got == [("v_1_A_G", "G1", None), ("v_2_A_G", None, None), ("v_3_A_G", None, None)]


def test_spliceai_separate_columns_and_single_column(spark):
    vep = spark.createDataFrame([("chr1_1_A_G", "0.1", None, "0.5", "-")],
                                "Uploaded_variation string, SpliceAI_pred_DS_AG string, "
                                "SpliceAI_pred_DS_AL string, SpliceAI_pred_DS_DG string, "
                                "SpliceAI_pred_DS_DL string")
    assert ops.tidy_vep(vep).collect()[0]["SpliceAI_delta_score"] == 0.5
    one = vep.select("Uploaded_variation", "SpliceAI_pred_DS_AG")
    assert ops.tidy_vep(one).collect()[0]["SpliceAI_delta_score"] == 0.1


def test_vcf_export_is_verbatim_with_the_input_header(spark, tmp_out):
    header = ["##fileformat=VCFv4.2", "##source=test", '##INFO=<ID=CSQ,Number=.,Type=String>',
              "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2"]
    body = [f"chr1\t{i}\tchr1_{i - 1}_A_G\tA\tG\t50\tPASS\tCSQ=x\tGT\t0/1\t1/1" for i in range(1, 40)]
    src, out = tmp_out + "/in", tmp_out + "/out"
    sinks.write_text(spark.createDataFrame([(b,) for b in body], "value string"), header, src)
    assert sources.read_vcf_header(spark, src, probe=2) == header
    vcf = sources.read_vcf(spark, src, keep_line=True)
    ids = spark.createDataFrame([("chr1_4_A_G",), ("chr1_9_A_G",), ("nope",)], "id string")
    sinks.write_vcf(ops.filter_variants(vcf, ids), sources.read_vcf_header(spark, src), out,
                    compression=None)
    lines = []
    for f in sorted(glob.glob(out.removeprefix("file:") + "/part-*")):
        lines += open(f).read().splitlines()
    assert lines == header + [body[4], body[9]]
