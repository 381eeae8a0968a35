"""Near-gene annotation: every (variant, transcript) pair within a distance,
with the distance, the side relative to the transcript's strand and, for
overlapping pairs, whether the variant is in an exon or an intron."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.operators.interval import DEFAULT_BIN, interval_join
from vartab.operators.joins import BROADCAST_MAX_BYTES

NEAR_GENE_COLUMNS = ["variant_id", "transcript_id", "distance", "side", "overlap"]


def near_gene(variants: DataFrame, transcripts: DataFrame, exons: DataFrame,
              distance: int = 5000, bin_size: int = DEFAULT_BIN,
              broadcast_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """``variants``: (variant_id, chrom, start) 0-based positions;
    ``transcripts``: (transcript_id, chrom, tx_start, tx_end, strand) and
    ``exons``: (transcript_id, chrom, exon_start, exon_end), half-open.

    distance = tx_start - start before the transcript, start - tx_end + 1
    after it, NULL inside. side = upstream when the variant is before a
    plus-strand or after a minus-strand transcript, else downstream; NULL
    inside. overlap = exon / intron inside, NULL outside. Padding each
    transcript by ``distance`` and using the binned interval join makes the
    window test exact with no pairwise comparison beyond a bin. A transcript
    carries its exons (a bounded number) as an array, so exon membership is
    a test on the joined row: one interval join, no join of pairs. Transcripts
    come from a gene model (~250k rows), cheap to measure, so their binned
    copies are broadcast when under ``broadcast_bytes``.
    """
    pts = variants.select("variant_id", F.col("chrom"), F.col("start").alias("pos"))
    per_tx = exons.groupBy(F.col("transcript_id"), F.col("chrom").alias("tx_chrom")).agg(
        F.collect_list(F.struct("exon_start", "exon_end")).alias("exons"))
    tx = transcripts.select("transcript_id", F.col("chrom").alias("tx_chrom"), "tx_start",
                            "tx_end", "strand",
                            F.greatest(F.col("tx_start") - distance, F.lit(0)).alias("pad_start"),
                            (F.col("tx_end") + distance).alias("pad_end")
                            ).join(per_tx, ["transcript_id", "tx_chrom"], "left")
    pairs = interval_join(pts, tx, point_chrom="chrom", point_pos="pos", interval_chrom="tx_chrom",
                          start="pad_start", end="pad_end", bin_size=bin_size,
                          broadcast_bytes=broadcast_bytes)
    pos = F.col("pos")
    before, after = pos < F.col("tx_start"), pos >= F.col("tx_end")
    dist = (F.when(before, F.col("tx_start") - pos)
            .when(after, pos - F.col("tx_end") + 1))
    side = F.when(before | after,
                  F.when(before == (F.col("strand") == 1), F.lit("upstream"))
                  .otherwise(F.lit("downstream")))
    in_exon = F.exists("exons", lambda e: (pos >= e["exon_start"]) & (pos < e["exon_end"]))
    overlap = F.when(~(before | after), F.when(in_exon, F.lit("exon")).otherwise(F.lit("intron")))
    return pairs.select("variant_id", "transcript_id", dist.alias("distance"), side.alias("side"),
                        overlap.alias("overlap"))
