"""Literal-row checks of the three re-aimed annotators (our definitions)."""

from vartab import operators as ops

TX = "transcript_id string, chrom string, tx_start bigint, tx_end bigint, strand int"
EX = ("transcript_id string, chrom string, exon_number int, n_exons int, "
      "exon_start bigint, exon_end bigint")
VAR = "variant_id string, chrom string, start bigint"


def test_near_gene_window_edges_sides_and_exons(spark):
    d = 100
    tx = spark.createDataFrame([("P", "1", 1000, 2000, 1), ("M", "1", 1000, 2000, -1)], TX)
    ex = spark.createDataFrame([("P", "1", 1, 2, 1000, 1100, ), ("P", "1", 2, 2, 1900, 2000),
                                ("M", "1", 1, 1, 1000, 1100)], EX)
    v = spark.createDataFrame([("a", "1", 900), ("b", "1", 899), ("c", "1", 2099),
                               ("d", "1", 2100), ("e", "1", 1050), ("f", "1", 1500),
                               ("g", "2", 1050)], VAR)
    got = {(r["variant_id"], r["transcript_id"]): (r["distance"], r["side"], r["overlap"])
           for r in ops.near_gene(v, tx, ex, distance=d).collect()}
    assert got == {
        ("a", "P"): (100, "upstream", None), ("a", "M"): (100, "downstream", None),
        ("c", "P"): (100, "downstream", None), ("c", "M"): (100, "upstream", None),
        ("e", "P"): (None, None, "exon"), ("e", "M"): (None, None, "exon"),
        ("f", "P"): (None, None, "intron"), ("f", "M"): (None, None, "intron"),
    }


def test_nmd_rules(spark):
    ex = spark.createDataFrame([
        ("P", "1", 1, 3, 0, 100), ("P", "1", 2, 3, 200, 300), ("P", "1", 3, 3, 400, 1000),
        ("S", "1", 1, 1, 5000, 5100)], EX)
    strands = spark.createDataFrame([("P", 1), ("S", -1)], "transcript_id string, strand int")
    ptc = spark.createDataFrame([
        ("early", "P", "1", 10), ("pen_far", "P", "1", 210), ("pen_near", "P", "1", 260),
        ("last", "P", "1", 500), ("intron", "P", "1", 150), ("single", "S", "1", 5010)],
        "variant_id string, transcript_id string, chrom string, pos bigint")
    got = {r["variant_id"]: r for r in
           ops.nmd_rules(ptc, ex, strands, long_exon_nt=400, start_nt=50).collect()}
    assert "intron" not in got
    assert got["early"]["ptc_offset"] == 10 and got["early"]["nmd_start_proximal_rule"]
    assert got["pen_far"]["ptc_offset"] == 110 and not got["pen_far"]["nmd_escape"]
    assert got["pen_near"]["nmd_50nt_penultimate_rule"] and got["pen_near"]["nmd_escape"]
    assert got["last"]["nmd_last_exon_rule"] and got["last"]["nmd_long_exon_rule"]
    # minus strand: offset counted from the exon's 3'-most genomic end
    assert got["single"]["nmd_single_exon_rule"] and got["single"]["ptc_offset"] == 89


def test_lookup_scores_skips_unconfigured_and_keeps_misses(spark):
    v = spark.createDataFrame([("a", "1", 5, "A", "G"), ("b", "1", 6, "A", "G")],
                              "variant_id string, chrom string, start bigint, ref string, alt string")
    s = spark.createDataFrame([("1", 5, "A", "G", 0.5)],
                              "chrom string, start bigint, ref string, alt string, x double")
    out = ops.lookup_scores(v, {"s": (s, ["x"]), "missing": None})
    assert out.columns == ["variant_id", "x"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", 0.5), ("b", None)]
