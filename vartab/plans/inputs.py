"""Fixture views reshaped into what the readers produce, so operators can
run on them without a text round trip (the ``scan_*`` queries do the
round trip)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.functions import null_tokens
from vartab.plans.fixtures import Fixtures

VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
]
GTF_HEADER = ["##description: derived test annotation", "##format: gtf"]


def vcf_rows(fx: Fixtures, track: str = "small") -> DataFrame:
    """fx_csq / fx_sv_csq as parsed VCF rows (0-based start)."""
    t = fx.fx_csq if track == "small" else fx.fx_sv_csq
    return t.select("variant_id", "chrom", (F.col("pos") - 1).alias("start"), "ref", "alt", "info")


def _strand_sign(c):
    return F.when(c == 1, F.lit("+")).otherwise(F.lit("-"))


def gtf_transcript_rows(fx: Fixtures) -> DataFrame:
    t = fx.fx_transcript
    return t.select(F.col("chrom").alias("seqname"), F.lit("fixture").alias("source"),
                    F.lit("transcript").alias("feature"),
                    (F.col("tx_start") + 1).alias("start"), F.col("tx_end").alias("end"),
                    F.lit(".").alias("score"), _strand_sign(F.col("strand")).alias("strand"),
                    F.lit(".").alias("frame"), F.col("attr").alias("attributes"))


def gtf_gene_rows(fx: Fixtures) -> DataFrame:
    g = fx.fx_gene.select("gene_unversioned", "gene_start", "gene_end", "strand")
    lines = fx.fx_gene_line.join(g, "gene_unversioned")
    attr = F.concat(F.lit('gene_id "'), F.col("gene_id"), F.lit('";'))
    return lines.select(F.col("chrom").alias("seqname"), F.lit("fixture").alias("source"),
                        F.lit("gene").alias("feature"),
                        (F.col("gene_start") + 1).alias("start"), F.col("gene_end").alias("end"),
                        F.lit(".").alias("score"), _strand_sign(F.col("strand")).alias("strand"),
                        F.lit(".").alias("frame"), attr.alias("attributes"))


def gtf_exon_rows(fx: Fixtures) -> DataFrame:
    x = fx.fx_exon.join(fx.fx_transcript.select("transcript_id", "strand"), "transcript_id")
    attr = F.format_string('transcript_id "%s"; exon_number %d;', "transcript_id", "exon_number")
    return x.select(F.col("chrom").alias("seqname"), F.lit("fixture").alias("source"),
                    F.lit("exon").alias("feature"), (F.col("exon_start") + 1).alias("start"),
                    F.col("exon_end").alias("end"), F.lit(".").alias("score"),
                    _strand_sign(F.col("strand")).alias("strand"), F.lit(".").alias("frame"),
                    attr.alias("attributes"))


def gtf_lines(gtf: DataFrame) -> DataFrame:
    return gtf.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in gtf.columns])
                      .alias("value"))


def vep_rows(fx: Fixtures) -> DataFrame:
    """fx_vep as the tab reader returns it: every column text, '-' -> NULL."""
    t = fx.fx_vep
    return t.select(*[null_tokens(c).alias(c) for c in t.columns])


def transcripts(fx: Fixtures) -> DataFrame:
    return fx.fx_transcript.select("transcript_id", "chrom", "tx_start", "tx_end", "strand")


def exons(fx: Fixtures) -> DataFrame:
    return fx.fx_exon.select("transcript_id", "chrom", "exon_number", "n_exons", "exon_start",
                             "exon_end")


def vep_tab_lines(fx: Fixtures) -> tuple[list[str], DataFrame]:
    """fx_vep as VEP ``--tab`` output: '##' block, '#'-prefixed header,
    '-' for missing values."""
    t = fx.fx_vep
    header = ["## ENSEMBL VARIANT EFFECT PREDICTOR", "## Output produced from fixtures",
              "#Uploaded_variation\t" + "\t".join(t.columns[1:])]
    lines = t.select(F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("-")) for c in t.columns])
                     .alias("value"))
    return header, lines


def write_input_files(fx: Fixtures, root: str, **config):
    """Write every fixture input the way the tools deliver it (gz VCF and
    GTF text, chunked VEP tab and NMD CSV, a folder of per-chromosome
    prediction files, nested score files with mixed key types) and return
    the matching ``AnnotationConfig``."""
    from vartab import sinks
    from vartab.plans.annotation import AnnotationConfig, E2GConfig

    root = root.rstrip("/")
    sinks.write_vcf(vcf_rows(fx), VCF_HEADER, f"{root}/variants.vcf")
    sinks.write_vcf(vcf_rows(fx, "sv"), VCF_HEADER, f"{root}/sv_variants.vcf")
    gtf = gtf_gene_rows(fx).unionByName(gtf_transcript_rows(fx))
    sinks.write_text(gtf_lines(sinks.sort_by_position(gtf, "seqname", "start")), GTF_HEADER,
                     f"{root}/annotation.gtf", compression="gzip")
    header, lines = vep_tab_lines(fx)
    chrom = F.split(F.col("value"), "_", 2).getItem(0)
    vep = []
    for i, cond in enumerate([chrom != "chr2", chrom == "chr2"]):
        sinks.write_text(lines.filter(cond), header, f"{root}/vep/chunk_{i}.vep.tsv",
                         compression="gzip")
        vep.append(f"{root}/vep/chunk_{i}.vep.tsv")
    nmd = fx.fx_nmd
    nmd.filter(F.col("chromosome") != "chr2").write.option("header", "true") \
        .csv(f"{root}/nmd/chunk_0.nmd.csv")
    nmd.filter(F.col("chromosome") == "chr2").write.option("header", "true") \
        .csv(f"{root}/nmd/chunk_1.nmd.csv")
    pred = fx.fx_prediction
    known = ["1", "2"]
    for c in known:
        pred.filter(F.col("chromosome") == c).write.parquet(f"{root}/predictions/{c}.parquet")
    rest = ~F.coalesce(F.col("chromosome").isin(known), F.lit(False))
    pred.filter(rest).write.parquet(f"{root}/predictions/others.parquet")
    fx.fx_enhancer.write.parquet(f"{root}/enhancers.parquet")
    s = fx.fx_splice
    s.filter(F.col("chrom") != "chr2").write.parquet(f"{root}/absplice/a/max_preds.parquet")
    (s.filter(F.col("chrom") == "chr2").withColumn("start", F.col("start").cast("string"))
     .write.parquet(f"{root}/absplice/b/c/max_preds.parquet"))
    e2g = config.pop("e2g", None) or E2GConfig()
    e2g.predictions, e2g.enhancers = f"{root}/predictions/*.parquet", f"{root}/enhancers.parquet"
    return AnnotationConfig(
        input_vcf=f"{root}/variants.vcf", sv_vcf=f"{root}/sv_variants.vcf",
        gtf=f"{root}/annotation.gtf", output_dir=f"{root}/out", vep_tab=vep,
        nmd_csv=[f"{root}/nmd/chunk_0.nmd.csv", f"{root}/nmd/chunk_1.nmd.csv"],
        e2g=e2g, absplice_result=f"{root}/absplice", **config)
