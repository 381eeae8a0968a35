"""The funnel: pick the near-gene small variants once, and hand only those
to the costly annotators (a semi-join on the variant id, or a test on each input
line by itself)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.functions import field, int_field, small_variant_type
from vartab.operators.consequence import CSQ_FIELDS, gene_entries
from vartab.operators.joins import measured_bytes

# Most bytes of the transcripts' ids that ``filter_lines`` carries in one value.
IDS_MAX_BYTES = 256 << 20


def toggle_filter(base: DataFrame, protein_coding_only: bool = False,
                  canonical_only: bool = False) -> DataFrame:
    """Optional row filters; a NULL gene_type/canonical (metadata miss) is
    dropped when its toggle is on."""
    if protein_coding_only:
        base = base.filter(F.col("gene_type") == "protein_coding")
    if canonical_only:
        base = base.filter(F.col("canonical"))
    return base


def _near_rows(base: DataFrame, window: int, protein_coding_only: bool,
               canonical_only: bool) -> DataFrame:
    rows = (base.filter(F.col("variant_type").isin("SNV", "indel"))
            .filter(F.col("distance").isNull() | (F.col("distance") <= window)))
    return toggle_filter(rows, protein_coding_only, canonical_only)


def analysis_set(base: DataFrame, window: int = 5000, protein_coding_only: bool = False,
                 canonical_only: bool = False) -> DataFrame:
    """Distinct small-variant ids with at least one transcript row inside the
    cis window (distance NULL = overlapping, or distance <= window)."""
    return _near_rows(base, window, protein_coding_only, canonical_only) \
        .select("variant_id").distinct()


VARIANT_KEYS = ["variant_id", "chrom", "start", "ref", "alt"]


def analysis_variants(base: DataFrame, window: int = 5000, protein_coding_only: bool = False,
                      canonical_only: bool = False) -> DataFrame:
    """The analysis set with its site columns, taken from the base table
    itself (it carries them), so the annotators need no second scan of the
    input VCF. Same variants as ``filter_variants(vcf, analysis_set(...))``."""
    return _near_rows(base, window, protein_coding_only, canonical_only) \
        .select(*VARIANT_KEYS).distinct()


def filter_variants(vcf: DataFrame, ids: DataFrame, key: str = "variant_id") -> DataFrame:
    """Input rows whose id is in ``ids`` (LEFT SEMI: no duplication, no
    columns from ``ids``); used to export the input lines themselves."""
    return vcf.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")


def _slots(ids: DataFrame, n: int) -> DataFrame:
    """One row: an array of n slots, each the ids that hash to it. As elements of an
    array are found in constant time, so is an id."""
    filled = ids.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias("slot")).agg(F.collect_list("id").alias("ids"))
    every = ids.sparkSession.range(n).withColumnRenamed("id", "slot")
    whole = every.join(filled, "slot", "left").select(F.struct("slot", F.coalesce("ids", F.array().cast("array<string>")).alias("ids")).alias("s"))
    return whole.agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["ids"]).alias("slots"))


def filter_lines(vcf: DataFrame, metadata: DataFrame | None = None, window: int = 5000, protein_coding_only: bool = False,
                 canonical_only: bool = False, max_bytes: int = IDS_MAX_BYTES) -> DataFrame:
    """The small-track input rows that are in the analysis set, told from each row's own
    CSQ payload, so that no row (its samples included) is shuffled: some entry has a
    gene, lies in the window and, with a toggle on, names a transcript whose metadata
    pass it. These transcripts' ids, at most ``max_bytes``, reach the rows as one value
    of a scalar subquery; beyond the bound use ``filter_variants``.

    Every row is judged by itself: of several rows with one id ``filter_variants`` keeps
    all or none, this each that qualifies; a row without an id is judged as any other."""
    near = gene_entries("info")
    distance = lambda p: int_field(field(p, CSQ_FIELDS["distance"]), "int")
    inside = lambda p: distance(p).isNull() | (distance(p) <= window)
    small = small_variant_type("ref", "alt").isin("SNV", "indel")
    if not protein_coding_only and not canonical_only:
        return vcf.filter(small & F.exists(near, inside))
    if metadata is None:
        raise ValueError("toggles need the transcript metadata")
    ids = (toggle_filter(metadata, protein_coding_only, canonical_only)
           .select(F.col("transcript_id").cast("string").alias("id")).dropna().distinct())
    if measured_bytes(ids) > max_bytes:
        raise ValueError(f"ids of the transcripts exceed {max_bytes} bytes: use filter_variants")
    n = max(1, ids.count())
    transcripts = F.transform(F.filter(near, inside), lambda p: field(p, CSQ_FIELDS["transcript"]))
    passes = lambda t: F.coalesce(F.array_contains(F.get("_slots", F.pmod(F.xxhash64(t), F.lit(n)).cast("int")), t), F.lit(False))
    return (vcf.withColumn("_slots", _slots(ids, n).scalar())
            .filter(small & F.exists(transcripts, passes)).select(*vcf.columns))


def chromosome_subset(df: DataFrame, chromosomes=None, col: str = "chrom") -> DataFrame:
    """Keep the listed chromosomes; an empty/None list keeps everything."""
    return df.filter(F.col(col).isin(*chromosomes)) if chromosomes else df
