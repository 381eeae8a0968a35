"""Reader edge cases: files of one source with different headers."""

from vartab import sinks, sources


def _text(spark, path, header, rows):
    sinks.write_text(spark.createDataFrame([(r,) for r in rows], "value string"), header, path)


def test_vep_tab_files_with_different_headers_union_by_name(spark, tmp_out):
    a, b = tmp_out + "/a", tmp_out + "/b"
    _text(spark, a, ["## VEP a", "#Uploaded_variation\tGene\tCADD_PHRED"],
          ["chr1_1_A_G\tG1\t12", "chr1_2_A_G\t-\t-"])
    _text(spark, b, ["## VEP b", "#Uploaded_variation\tGene\tLoF\tFeature"],
          ["chr2_5_A_G\tG2\tHC\tT2"])
    df = sources.read_vep_tab(spark, [a, b])
    assert set(df.columns) == {"Uploaded_variation", "Gene", "CADD_PHRED", "LoF", "Feature"}
    got = {r["Uploaded_variation"]: r.asDict() for r in df.collect()}
    assert got["chr1_1_A_G"]["CADD_PHRED"] == "12" and got["chr1_1_A_G"]["LoF"] is None
    assert got["chr1_2_A_G"]["Gene"] is None
    assert got["chr2_5_A_G"]["Feature"] == "T2" and got["chr2_5_A_G"]["CADD_PHRED"] is None


def test_csv_chunks_with_reordered_columns_keep_values_in_place(spark, tmp_out):
    a, b = tmp_out + "/a.csv", tmp_out + "/b.csv"
    spark.createDataFrame([("chr1", "5", "A", "G", "T1", "True")],
                          "chromosome string, start_variant string, ref string, alt string, "
                          "transcript_id string, nmd_escape string").write.option("header", True).csv(a)
    spark.createDataFrame([("False", "T2", "G", "A", "9", "chr2", "x")],
                          "nmd_escape string, transcript_id string, alt string, ref string, "
                          "start_variant string, chromosome string, other string") \
        .write.option("header", True).csv(b)
    got = {r["transcript_id"]: r.asDict() for r in sources.read_nmd_csv(spark, [a, b]).collect()}
    assert got["T2"]["chromosome"] == "chr2" and got["T2"]["start_variant"] == "9"
    assert got["T2"]["nmd_escape"] == "False" and got["T1"]["nmd_escape"] == "True"


def test_gtf_comments_and_feature_filter(spark, tmp_out):
    _text(spark, tmp_out, ["#!genome-build test", "##provider: test"],
          ['chr1\tsrc\tgene\t11\t100\t.\t+\t.\tgene_id "G1";',
           'chr1\tsrc\ttranscript\t11\t90\t.\t+\t.\tgene_id "G1"; transcript_id "T1";',
           'chr1\tsrc\texon\t11\t20\t.\t+\t.\tgene_id "G1"; transcript_id "T1";'])
    tx = sources.read_gtf(spark, tmp_out, "transcript").collect()
    assert len(tx) == 1 and tx[0]["start"] == 11 and tx[0]["end"] == 90
    assert sources.read_gtf(spark, tmp_out).count() == 3
