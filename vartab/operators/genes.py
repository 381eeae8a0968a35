"""Unversioned -> versioned gene id maps built from GTF ``gene`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.functions import attr_value, strip_version
from vartab.operators.joins import BROADCAST_MAX_BYTES, broadcast_if_small


def gene_ids(gtf_genes: DataFrame, attr: str = "attributes") -> DataFrame:
    """(gene_id, gene_id_unversioned) for every gene row."""
    gid = attr_value(F.col(attr), "gene_id")
    return gtf_genes.select(gid.alias("gene_id"), strip_version(gid).alias("gene_id_unversioned"))


def gene_version_map(gtf_genes: DataFrame, fan_out: bool = False,
                     attr: str = "attributes") -> DataFrame:
    """Map keyed by ``gene_id_unversioned``.

    ``fan_out=False``: one row per unversioned id; when two versioned ids
    share it (e.g. a ``_PAR_Y`` copy) the smallest is kept, deterministically.
    ``fan_out=True``: every distinct (gene_id, unversioned) pair, so a join
    through it repeats rows for shared ids.
    """
    ids = gene_ids(gtf_genes, attr)
    if fan_out:
        return ids.distinct()
    return ids.groupBy("gene_id_unversioned").agg(F.min("gene_id").alias("gene_id")) \
        .select("gene_id", "gene_id_unversioned")


def map_gene_versions(df: DataFrame, gene_map: DataFrame, col: str, out: str | None = None,
                      broadcast_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """Replace unversioned ids in ``col`` by the versioned id when the map
    has one, else keep the original (left join + coalesce).

    The map (one row per gene, ~60k) is broadcast behind a size check, so a
    gene that owns a large share of ``df`` never lands in a single task."""
    out = out or col
    m = gene_map.select(F.col("gene_id_unversioned").alias("_gu"), F.col("gene_id").alias("_gv"))
    m = broadcast_if_small(m, broadcast_bytes)
    j = df.join(m, df[col] == m["_gu"], "left")
    return j.withColumn(out, F.coalesce(F.col("_gv"), F.col(col))).drop("_gu", "_gv")
