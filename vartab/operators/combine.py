"""Assemble the wide annotation table: base rows left-joined with every
enabled tool part."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vartab.functions import CONSEQUENCE_TERMS, onehot_columns
from vartab.operators.funnel import toggle_filter
from vartab.operators.heavy import copy_to_salts, salt_rows
from vartab.session import session_beside

# Tool columns not carried into the combined table (join
# keys or duplicates of base columns), and the E2G column prefix.
VEP_DROP = {"variant_id", "chrom", "start", "ref", "alt", "Feature", "variant_type",
            "Gene", "BIOTYPE", "CANONICAL", "IMPACT", "SYMBOL", "Consequence"}
NMD_DROP = {"variant_id", "transcript"}
E2G_DROP = {"variant_id", "target_gene_id"}
E2G_PREFIX = "e2g_"
SPLICE_DROP = {"variant_id", "gene"}


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``df`` that occur more than once, with their count. Part
    tables are not required to be unique; duplicates fan out."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


COPARTITION_CONF = "spark.sql.requireAllClusterKeysForCoPartition"


def copartition_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, with its settings, in which a join may leave sides in
    place that are dealt by some of its keys. Frames read in it are planned so; ``spark``
    itself, and every other query of it, keeps its setting."""
    return session_beside(spark, {COPARTITION_CONF: "false"})


def combine(base: DataFrame, vep: DataFrame | None = None, nmd: DataFrame | None = None,
            e2g: DataFrame | None = None, splice: DataFrame | None = None,
            scores: DataFrame | None = None, *, protein_coding_only: bool = False, canonical_only: bool = False,
            copartition: bool | int = False, heavy: DataFrame | None = None, dealt: Collection[str] = ()) -> DataFrame:
    """Base rows (+ consequence one-hots, int, NULL -> 0), left-joined with
    any subset of the parts: VEP and NMD on (variant_id, transcript), E2G
    and splice on (variant_id, gene), site scores on variant_id. Toggles
    filter base rows (Spark pushes them to the scan).

    Layout: with ``copartition`` every side is hash-partitioned by
    ``variant_id`` alone, so the wide base is shuffled once for all joins
    (True: as many partitions as adaptive execution sees fit; a number: that
    many). The base must then come from a ``copartition_session``. ``heavy``
    (``heavy_ids``) names the ids with too many rows for one task: they are salted
    on the base and copied on the parts, and all sides are dealt by id and salt.
    ``dealt`` names parts that are hash-partitioned by ``variant_id`` as they come
    (``enhancer_links(by_variant=True)``): without ``heavy``, they stay where they are.
    Without ``copartition``, transcript-keyed parts are joined
    first so both share one shuffle of the base, then the gene-keyed ones
    (two base shuffles), and adaptive execution can split a skewed base
    partition in every join.
    """
    spark = base.sparkSession
    if copartition and spark.conf.get(COPARTITION_CONF, "true").lower() != "false":
        raise ValueError(f"copartition needs {COPARTITION_CONF}=false")
    if heavy is not None and not copartition:
        raise ValueError("heavy ids are salted in the copartition layout only")
    out = toggle_filter(base, protein_coding_only, canonical_only)
    if all(p is None for p in (vep, nmd, e2g, splice, scores)):
        copartition, heavy = False, None  # no join: the base stays where it is
    columns, salts = out.columns, ["_salt"] if heavy is not None else []

    def deal(df: DataFrame) -> DataFrame:
        if not copartition:
            return df
        by = ["variant_id", *salts]
        return df.repartition(*by) if copartition is True else df.repartition(copartition, *by)

    out = deal(salt_rows(out, heavy, "_salt") if salts else out)
    # One-hots are derived from ``consequence`` after the joins, so the
    # shuffles carry one text column instead of 17 extra ones.
    onehots = onehot_columns("consequence", null_as_zero=True)
    order = columns + [f"Consequence_{t}" for t in CONSEQUENCE_TERMS]

    def attach(out, part, drop, keys, rename, prefix="", drop_prefix=None, stays=False):
        extra = [c for c in part.columns if c not in drop
                 and not (drop_prefix and c.startswith(drop_prefix))]
        right = part.select(*[F.col(src).alias(dst) for src, dst in rename.items()],
                            *[F.col(c).alias(prefix + c) for c in extra])
        order.extend(prefix + c for c in extra)
        if salts:
            right = copy_to_salts(right, heavy, "_salt")
        return out.join(right if stays and not salts else deal(right), keys + salts, "left")

    if vep is not None:
        out = attach(out, vep, VEP_DROP, ["variant_id", "transcript"],
                     {"variant_id": "variant_id", "Feature": "transcript"},
                     drop_prefix="Consequence")
    if nmd is not None:
        out = attach(out, nmd, NMD_DROP, ["variant_id", "transcript"],
                     {"variant_id": "variant_id", "transcript": "transcript"})
    if e2g is not None:
        out = attach(out, e2g, E2G_DROP, ["variant_id", "gene"],
                     {"variant_id": "variant_id", "target_gene_id": "gene"}, E2G_PREFIX, stays="e2g" in dealt)
    if splice is not None:
        out = attach(out, splice, SPLICE_DROP, ["variant_id", "gene"],
                     {"variant_id": "variant_id", "gene": "gene"})
    if scores is not None:
        out = attach(out, scores, {"variant_id"}, ["variant_id"], {"variant_id": "variant_id"})
    named = {f"Consequence_{t}": c for t, c in zip(CONSEQUENCE_TERMS, onehots)}
    return out.select(*[named.get(c, F.col(c)) for c in order])
