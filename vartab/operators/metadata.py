"""GTF transcript lines -> transcript metadata with one canonical pick per gene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vartab.functions import attr_value, has_tag, nullif_empty

METADATA_COLUMNS = ["transcript_id", "gene_id", "symbol", "gene_type", "biotype", "tsl",
                    "appris", "mane_select", "basic", "ccds", "principal", "canonical"]


def gtf_attributes(gtf: DataFrame, attr: str = "attributes") -> DataFrame:
    """Attribute string -> id, name, type, tsl (raw text), appris tag and
    three tag flags. Absent attributes are NULL."""
    a = F.col(attr)
    return gtf.select(
        attr_value(a, "transcript_id").alias("transcript_id"),
        attr_value(a, "gene_id").alias("gene_id"),
        attr_value(a, "gene_name").alias("symbol"),
        attr_value(a, "gene_type").alias("gene_type"),
        attr_value(a, "transcript_type").alias("biotype"),
        attr_value(a, "transcript_support_level").alias("tsl"),
        nullif_empty(F.regexp_extract(a, r'tag "(appris_[a-z0-9_]+)"', 1)).alias("appris"),
        has_tag(a, "MANE_Select").alias("mane_select"),
        has_tag(a, "basic").alias("basic"),
        has_tag(a, "CCDS").alias("ccds"),
    )


def canonical_picks(attrs: DataFrame) -> DataFrame:
    """One canonical transcript per gene: MANE Select first, else the lowest
    APPRIS principal rank; ties go to the smallest transcript id.

    A plain grouped ``min`` over (priority, transcript_id): partial
    aggregation runs map-side, so a gene with very many transcripts never
    lands in one task as raw rows.
    """
    prio = F.when(F.col("mane_select"), F.lit(0)).otherwise(F.col("principal").cast("int"))
    eligible = F.col("mane_select") | F.col("principal").isNotNull()
    return (attrs.filter(eligible)
            .groupBy("gene_id")
            .agg(F.min(F.struct(prio.alias("prio"), F.col("transcript_id"))).alias("pick"))
            .select("gene_id", F.col("pick.transcript_id").alias("canonical_tx")))


def transcript_metadata(gtf_transcripts: DataFrame, attr: str = "attributes") -> DataFrame:
    """GTF ``transcript`` rows -> 12-column transcript metadata."""
    attrs = gtf_attributes(gtf_transcripts, attr).withColumn(
        "principal",
        nullif_empty(F.regexp_extract(F.col("appris"), r"appris_principal_([0-9])", 1))
        .cast("tinyint"))
    picks = canonical_picks(attrs)
    canonical = F.coalesce(F.col("transcript_id") == F.col("canonical_tx"), F.lit(False))
    tsl = F.when(F.col("tsl") == "NA", F.lit(None)).otherwise(F.col("tsl")).try_cast("tinyint")
    return (attrs.join(picks, "gene_id", "left")
            .select("transcript_id", "gene_id", "symbol", "gene_type", "biotype",
                    tsl.alias("tsl"), "appris", "mane_select", "basic", "ccds", "principal",
                    canonical.alias("canonical")))


def _strand(c: Column) -> Column:
    return F.when(c == "-", F.lit(-1)).otherwise(F.lit(1))


def transcripts_from_gtf(gtf: DataFrame, attr: str = "attributes") -> DataFrame:
    """GTF rows -> (transcript_id, chrom, tx_start, tx_end, strand) of its
    transcripts: half-open 0-based positions, strand 1 or -1."""
    t = gtf.filter(F.col("feature") == "transcript")
    return t.select(attr_value(F.col(attr), "transcript_id").alias("transcript_id"), F.col("seqname").alias("chrom"),
                    (F.col("start") - 1).alias("tx_start"), F.col("end").alias("tx_end"),
                    _strand(F.col("strand")).alias("strand"))


def exons_from_gtf(gtf: DataFrame, attr: str = "attributes") -> DataFrame:
    """GTF rows -> (transcript_id, chrom, exon_number, n_exons, exon_start,
    exon_end) of its exons. Numbers are the file's (``exon_number 3`` or
    ``exon_number "3"``); where it has none, exons are counted along the
    transcript. A transcript has a bounded number of exons, so each window
    partition is small."""
    e = gtf.filter(F.col("feature") == "exon").select(
        attr_value(F.col(attr), "transcript_id").alias("transcript_id"), F.col("seqname").alias("chrom"),
        (F.col("start") - 1).alias("exon_start"), F.col("end").alias("exon_end"), _strand(F.col("strand")).alias("_s"),
        F.regexp_extract(F.col(attr), r'exon_number "?([0-9]+)', 1).try_cast("int").alias("_n"))
    along = Window.partitionBy("transcript_id").orderBy(F.col("_s") * F.col("exon_start"))
    whole = Window.partitionBy("transcript_id")
    return e.select("transcript_id", "chrom", F.coalesce("_n", F.row_number().over(along)).alias("exon_number"),
                    F.count(F.lit(1)).over(whole).cast("int").alias("n_exons"), "exon_start", "exon_end")
