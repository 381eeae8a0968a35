"""Precomputed score lookups keyed by site (chrom, start, ref, alt)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.functions import strip_chr as _strip_chr
from vartab.operators import site_filter
from vartab.operators.joins import BROADCAST_MAX_BYTES, broadcast_if_small
from vartab.sources.bucketed import BucketedScores

SITE_KEYS = ("chrom", "start", "ref", "alt")
SPLICE_COLUMNS = ["variant_id", "gene", "AbSplice_DNA_max", "AbSplice2_max"]
_MOST_CHROMOSOMES = 1000


def site_keys(df: DataFrame, strip_chr: bool = False) -> list:
    """The site columns with one type on every side of a lookup: text and
    bigint, the chromosome without ``chr`` if asked for."""
    chrom = F.col("chrom").cast("string")
    return [(_strip_chr(chrom) if strip_chr else chrom).alias("chrom"),
            F.col("start").cast("bigint").alias("start"),
            F.col("ref").cast("string").alias("ref"), F.col("alt").cast("string").alias("alt")]


def on_chromosomes_of(scores: DataFrame, sites: DataFrame, strip_chr: bool = False) -> DataFrame:
    """``scores`` without the chromosomes that no site is on: a literal list, so
    that a table partitioned by ``chrom`` is pruned when it is planned. A reference
    with more sequences than ``_MOST_CHROMOSOMES`` is read whole. With ``strip_chr``
    the test is on the stripped name, as several names strip to the same one."""
    chrom = F.col("chrom").cast("string")
    key = _strip_chr(chrom) if strip_chr else chrom
    names = sites.select(key.alias("c")).filter(F.col("c").isNotNull()).distinct()
    found = [r["c"] for r in names.limit(_MOST_CHROMOSOMES + 1).collect()]
    if len(found) > _MOST_CHROMOSOMES:
        return scores
    return scores.filter(key.isin(found))


def _thinned(scores: DataFrame, sites: DataFrame, max_bytes: int | None) -> DataFrame:
    """``scores`` less most rows at none of the (many) sites, by a Bloom filter."""
    made = site_filter.build(sites, SITE_KEYS, max_bytes) if max_bytes else None
    return site_filter.reduce_by(scores, made) if made else scores


def splice_lookup(variants: DataFrame, scores: DataFrame | BucketedScores, gene_pairs: DataFrame,
                  strip_chr: bool = False, broadcast_bytes: int | None = BROADCAST_MAX_BYTES,
                  prune: bool = False, filter_bytes: int | None = site_filter.FILTER_MAX_BYTES) -> DataFrame:
    """Per-(variant, gene) splice scores: inner join on the site, then the
    unversioned gene id is versioned through ``gene_pairs`` (every pair, so
    an id shared by two versioned genes yields two rows), falling back to
    the unversioned id. Chromosome names are compared as given unless
    ``strip_chr``. ``prune``: read only the sites' chromosomes (one small job
    over the variants, so pass stored ones).

    Site join: when the variant side (the funnel's sites) is measured to be
    small, it is broadcast and the score table (billions of rows) streams
    through without any shuffle. Beyond that bound a Bloom filter of the sites
    (at most ``filter_bytes``) thins out the score rows where they are scanned and
    what is left shuffles with the sites (these are unique, so no key is hot). A
    bucketed score table stays in place and only the sites are dealt; it has to
    be written with the ``strip_chr`` of the lookup. The gene-pair map is
    broadcast behind a size check because one gene can own a large share of
    the score rows. ``broadcast_bytes=None`` plans the shuffles, unfiltered."""
    v = variants.select("variant_id", *site_keys(variants, strip_chr))
    buckets = scores.buckets if isinstance(scores, BucketedScores) else None
    table = scores.df if buckets else scores
    if prune:
        table = on_chromosomes_of(table, variants, strip_chr)
    keys = list(SITE_KEYS) if buckets else site_keys(table, strip_chr)
    a = table.select(*keys, F.col("gene_id").cast("string").alias("gene_unversioned"), "AbSplice_DNA_max", "AbSplice2_max")
    sites = broadcast_if_small(v, broadcast_bytes)
    if sites is v and buckets:
        sites = v.repartition(buckets, *SITE_KEYS).hint("merge")
    elif sites is v and broadcast_bytes is not None:
        a = _thinned(a, v, filter_bytes)
    hits = sites.join(a, list(SITE_KEYS))
    g = broadcast_if_small(gene_pairs.select(F.col("gene_id").alias("gene"),
                                             F.col("gene_id_unversioned").alias("gene_unversioned")),
                           broadcast_bytes)
    return (hits.join(g, "gene_unversioned", "left")
            .select("variant_id", F.coalesce("gene", "gene_unversioned").alias("gene"),
                    "AbSplice_DNA_max", "AbSplice2_max"))


def lookup_scores(variants: DataFrame, sources: Mapping[str, tuple[DataFrame | BucketedScores, Sequence[str]] | None],
                  strip_chr: bool = False, broadcast_bytes: int | None = BROADCAST_MAX_BYTES,
                  prune: bool = False, filter_bytes: int | None = site_filter.FILTER_MAX_BYTES) -> DataFrame:
    """Left-join every configured site-score source onto the variants.

    ``sources`` maps a source name to ``(table, score_columns)`` or to None
    when the source is not configured (it is skipped, its columns absent).
    A score column that several sources have comes out as ``source_column``.
    Keys are compared as text and bigint; with ``strip_chr`` a ``chr1`` site
    meets a ``1`` row. A source with repeated keys repeats the variant's row,
    as any left join. ``prune`` as in ``splice_lookup``.

    Score tables can be hundreds of GB. When the variant sites are measured
    to be small, each table is first reduced by a LEFT SEMI join against the
    broadcast sites (the table streams, nothing of it is shuffled), and only
    the matching rows take part in the left join. Beyond that bound a Bloom filter
    of the sites (``filter_bytes``) reduces it, one for all sources, and each join
    shuffles on the site keys; the variant side keeps that partitioning
    across sources. Bucketed tables are not moved: the variants are dealt to as many
    partitions as there are buckets, once for all sources of the same number.
    """
    keys = list(SITE_KEYS)
    used = {name: src for name, src in sources.items() if src is not None}
    times = Counter(c for _, cols in used.values() for c in cols)
    out = variants.select("variant_id", *site_keys(variants, strip_chr))
    sites = out.select(*keys)
    small = broadcast_if_small(sites, broadcast_bytes) if used else sites
    plain = any(not isinstance(table, BucketedScores) for table, _ in used.values())
    made = (site_filter.build(sites, SITE_KEYS, filter_bytes)
            if plain and small is sites and broadcast_bytes is not None and filter_bytes else None)
    cols: list[str] = []
    dealt = None
    for name, (source, score_cols) in used.items():
        buckets = source.buckets if isinstance(source, BucketedScores) else None
        table = source.df if buckets else source
        named = [c if times[c] == 1 else f"{name}_{c}" for c in score_cols]
        if len(set(named) | set(cols) | {"variant_id"}) != len(named) + len(cols) + 1:
            raise ValueError(f"score columns of {name} clash with others: {named}")
        if prune:
            table = on_chromosomes_of(table, variants, strip_chr)
        right = table.select(*(keys if buckets else site_keys(table, strip_chr)),
                             *[F.col(c).alias(n) for c, n in zip(score_cols, named)])
        if small is not sites:
            right = right.join(small, keys, "left_semi")
        elif buckets and dealt != buckets:
            out, dealt = out.repartition(buckets, *keys).hint("merge"), buckets
        elif made and not buckets:
            right = site_filter.reduce_by(right, made)
        out = out.join(right, keys, "left")
        cols += named
    return out.select("variant_id", *cols)
