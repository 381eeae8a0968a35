"""Enhancer -> target-gene links per variant (E2G star schema)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.functions import strip_chr
from vartab.operators.genes import map_gene_versions
from vartab.operators.interval import BIN, DEFAULT_BIN, bin_of, interval_join
from vartab.session import shuffles_dropped

E2G_COLUMNS = ["variant_id", "target_gene_id", "target_gene_name", "e2g_score",
               "enhancer_class", "distance_to_tss", "n_cell_types"]


def collapse_pairs(predictions: DataFrame, model: str = "ENCODE-rE2G",
                   score_threshold: float = 0.5,
                   cell_types: Sequence[str] | None = None) -> DataFrame:
    """Collapse cell types: one row per (enhancer, gene) with the max score
    over cell types and how many cell types support it; pairs whose max is
    below the threshold are dropped. Done before the interval join so the
    join sees unique pairs, not per-cell-type rows. Partial aggregation
    runs map-side, so a hot pair never reaches one task as raw rows."""
    p = predictions.filter(F.col("model") == model)
    if cell_types:
        p = p.filter(F.col("cell_type_id").isin(*cell_types))
    return (p.groupBy("enhancer_id", "target_gene_id")
            .agg(F.min("target_gene_name").alias("target_gene_name"),
                 F.min("target_gene_tss").alias("target_gene_tss"),
                 F.max("score").alias("score"),
                 F.count_distinct("cell_type_id").alias("n_cell_types"))
            .filter(F.col("score") >= F.lit(float(score_threshold))))


def pair_intervals(pairs: DataFrame, enhancers: DataFrame,
                   classes: Sequence[str] | None = None) -> DataFrame:
    """Attach each pair's enhancer interval and class (inner join on id);
    ``classes`` keeps only those enhancer classes (empty/None = all)."""
    enh = enhancers.select(F.col("id").alias("enhancer_id"), F.col("chromosome").alias("chrom"),
                           "start", "end", "class")
    if classes:
        enh = enh.filter(F.col("class").isin(*classes))
    return pairs.join(enh, "enhancer_id")


# Variants of one task of the links, and the most in one bin for which all its hits may
# be grouped in the task that makes them.
TASK_VARIANTS, BIN_VARIANTS = 100_000, 1_000_000


def local_partitions(variants: DataFrame, bin_size: int = DEFAULT_BIN) -> int | None:
    """Into how many parts ``enhancer_hits`` may deal ``variants`` (stored ones: this is a
    scan) so that all hits of an id are made in one task. None if an id may lie in several
    bins, as far as its text tells (it must begin with the chromosome, without a ``_``, and
    the start), or if a bin holds too many variants for a task."""
    chrom, start = F.col("chrom").cast("string"), F.col("start")
    named = ~chrom.contains("_") & F.startswith("variant_id", F.concat_ws("_", chrom, start.cast("string"), F.lit("")))
    bins = (variants.filter(chrom.isNotNull() & start.isNotNull())
            .groupBy(strip_chr(chrom).alias("chrom"), bin_of(start, bin_size).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce(named, F.lit(False))).alias("named")))
    with shuffles_dropped(variants.sparkSession):
        found = bins.agg(F.sum("n").alias("rows"), F.max("n").alias("most"), F.min("named").alias("named")).collect()[0]
    if not found["named"] or found["most"] > BIN_VARIANTS:
        return None
    return -(-found["rows"] // TASK_VARIANTS)


def enhancer_hits(variants: DataFrame, pairs_iv: DataFrame,
                  bin_size: int = DEFAULT_BIN, partitions: int | None = None) -> DataFrame:
    """Variants (0-based ``start``, 'chr' stripped) inside enhancer
    intervals, one row per (variant, pair). ``partitions`` (``local_partitions``) also
    keeps the variant's bin, by which ``variant_gene_links`` groups where the hits are."""
    v = variants.select("variant_id", strip_chr(F.col("chrom")).alias("chrom"),
                        F.col("start").alias("vstart"))
    return interval_join(v, pairs_iv, point_chrom="chrom", point_pos="vstart",
                         interval_chrom="chrom", start="start", end="end", bin_size=bin_size, partitions=partitions)


def variant_gene_links(hits: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Collapse hits to (variant, target gene, gene name): max score,
    nearest TSS distance, a deterministic class (min) and max cell-type
    support. ``also``: further columns that follow from the target gene. Hits that carry
    their bin are of ids that lie in one bin each, and are not shuffled."""
    keys = ["variant_id", "target_gene_id", "target_gene_name", *also]
    place = ["chrom", BIN] if BIN in hits.columns else []
    return (hits.groupBy(*place, *keys)
            .agg(F.max("score").alias("e2g_score"),
                 F.min(F.abs(F.col("vstart") - F.col("target_gene_tss"))).alias("distance_to_tss"),
                 F.min("class").alias("enhancer_class"),
                 F.max("n_cell_types").alias("n_cell_types"))
            .drop(*place))


def enhancer_links(variants: DataFrame, predictions: DataFrame, enhancers: DataFrame,
                   gene_map: DataFrame, *, model: str = "ENCODE-rE2G",
                   score_threshold: float = 0.5, classes: Sequence[str] | None = None,
                   cell_types: Sequence[str] | None = None, distance_to_tss: int | None = None,
                   bin_size: int = DEFAULT_BIN, by_variant: bool = False, stored: bool = False) -> DataFrame:
    """The E2G part: one row per (variant, target gene[, name]), target gene
    ids versioned through ``gene_map`` where possible, optional TSS cap. The ids are
    versioned on the pairs, before each of them meets its many variants.
    ``by_variant`` deals the hits by variant id alone, which a join on it can keep
    (``combine``); a variant has a bounded number of hits. ``stored``: the variants are
    a stored table, which is looked at for a way to group the hits where they are made."""
    pairs = pair_intervals(collapse_pairs(predictions, model, score_threshold, cell_types),
                           enhancers, classes)
    partitions = local_partitions(variants, bin_size) if stored and not by_variant else None
    hits = enhancer_hits(variants, map_gene_versions(pairs, gene_map, "target_gene_id", "_versioned"), bin_size, partitions)
    if by_variant:
        hits = hits.repartition("variant_id")
    links = variant_gene_links(hits, ["_versioned"])
    out = links.withColumn("target_gene_id", F.col("_versioned")).select(*E2G_COLUMNS)
    if distance_to_tss is not None:
        out = out.filter(F.col("distance_to_tss") <= int(distance_to_tss))
    return out
