"""Point-in-interval join by genomic binning.

A range predicate alone gives Spark nothing to hash on but the chromosome
(~24 keys, so ~24 busy tasks). Binning turns it into an equi-join on
(chrom, bin): each interval is copied to every ``bin_size`` bin it spans,
each point sits in exactly one bin, so a (point, interval) pair meets in
exactly one bin and is produced once. The exact half-open containment
test runs as the join's residual condition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vartab.operators.joins import broadcast_if_small

DEFAULT_BIN = 10_000
BIN = "point_bin"
# Bin sizes for intervals of very different length; the largest holds a chromosome.
NESTED_BINS = tuple(1 << k for k in range(14, 30, 3))


def bin_of(pos: Column, bin_size: int) -> Column:
    return F.floor(pos / F.lit(bin_size)).cast("bigint")


def interval_bins(intervals: DataFrame, start: str = "start", end: str = "end",
                  bin_size: int = DEFAULT_BIN, bin_col: str = "bin") -> DataFrame:
    """One row per (interval, bin it touches) for half-open [start, end).
    Empty intervals (end <= start) touch no bin."""
    s, e = F.col(start), F.col(end)
    bins = F.sequence(bin_of(s, bin_size), bin_of(e - F.lit(1), bin_size))
    return intervals.filter(e > s).withColumn(bin_col, F.explode(bins))


def _level(length: Column, sizes: Sequence[int]) -> Column:
    """The least of ``sizes`` that holds an interval, by its number (the last, if none)."""
    level = F.lit(len(sizes) - 1)
    for k in range(len(sizes) - 2, -1, -1):
        level = F.when(length <= sizes[k], k).otherwise(level)
    return level


def _size_of(level: Column, sizes: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(s).cast("bigint") for s in sizes]), level + 1)


def nested_bins(intervals: DataFrame, start: str = "start", end: str = "end", sizes: Sequence[int] = NESTED_BINS,
                bin_col: str = "bin", level_col: str = "level") -> DataFrame:
    """One row per (interval, bin it touches) of the least bin size that holds it: one or
    two rows, however long the interval (more only beyond the largest size)."""
    s, e = F.col(start), F.col(end)
    size = _size_of(F.col(level_col), sizes)
    first, last = F.floor(s / size).cast("bigint"), F.floor((e - F.lit(1)) / size).cast("bigint")
    return (intervals.filter(e > s).withColumn(level_col, _level(e - s, sizes).cast("int"))
            .withColumn(bin_col, F.explode(F.sequence(first, last))))


def _parts(level: Column, sizes: Sequence[int]) -> Column:
    """Parts of a bin: as many as bins of the next smaller size are in it; the smallest
    bins are whole."""
    n = [1] + [max(1, b // a) for a, b in zip(sizes, sizes[1:])]
    return F.element_at(F.array(*[F.lit(k).cast("bigint") for k in n]), level + 1)


def _part_of(pos: Column, level: Column, sizes: Sequence[int]) -> Column:
    """The part of its bin that ``pos`` lies in (the last takes what division leaves over)."""
    size, n = _size_of(level, sizes), _parts(level, sizes)
    inside = pos - F.floor(pos / size).cast("bigint") * size
    return F.least(F.floor(inside / F.floor(size / n)).cast("bigint"), n - 1)


def _with_parts(binned: DataFrame, start: str, end: str, sizes: Sequence[int]) -> DataFrame:
    """The rows of ``nested_bins`` once for every part of their bin that the interval
    touches. A bin may hold many times the points of one of its intervals; a point then
    only meets those that reach its part."""
    size = _size_of(F.col("_ilevel"), sizes)
    first = F.greatest(F.col(start), F.col("_ibin") * size)
    last = F.least(F.col(end), (F.col("_ibin") + 1) * size) - F.lit(1)
    return binned.withColumn("_ipart", F.explode(F.sequence(
        _part_of(first, F.col("_ilevel"), sizes), _part_of(last, F.col("_ilevel"), sizes))))


def _levels_in_use(intervals: DataFrame, start: str, end: str, sizes: Sequence[int]) -> list[int]:
    """The levels that some interval is in (at most ``len(sizes)`` numbers)."""
    own = intervals.filter(F.col(end) > F.col(start)).select(_level(F.col(end) - F.col(start), sizes).alias("k"))
    return sorted(r["k"] for r in own.distinct().collect())


def interval_join(points: DataFrame, intervals: DataFrame, *, point_chrom: str = "chrom",
                  point_pos: str = "pos", interval_chrom: str = "chrom",
                  start: str = "start", end: str = "end",
                  bin_size: int | Sequence[int] | None = DEFAULT_BIN, how: str = "inner",
                  broadcast_bytes: int | None = None, partitions: int | None = None) -> DataFrame:
    """All (point, interval) pairs with chrom equal and start <= pos < end.

    Column names of the two inputs must be distinct apart from
    ``point_chrom``/``interval_chrom`` (those may be equal; the point's copy
    is kept). ``how='left'`` keeps points that hit nothing.
    ``bin_size=None`` plans the plain range join (hash on chrom only); it
    exists to measure and test the binned form against.
    Several sizes (``NESTED_BINS``) put each interval into bins of the least size that
    holds it, two at most, of these into the parts it touches, and look for a point in
    one part of one bin of each size that is in use (one small job over the intervals
    tells): for intervals of very different length,
    where copies by a single size would grow with the length.

    Side choice: the points (variants) are the big, growing side and are
    never broadcast, since a broadcast build side leaves all output to the
    tasks of the other side. By default both sides are shuffled on
    (chrom, bin) with a sort-merge join (pinned by a hint, so adaptive
    execution cannot broadcast the points), and a skewed partition (a
    dense bin) is split by adaptive skew handling. With ``broadcast_bytes``
    the binned intervals are broadcast when measured to be small; the
    measurement runs the interval side's plan once more, so pass it
    only when that side is a cheap scan (e.g. transcripts of a GTF).
    ``partitions`` (with one bin size): both sides are dealt into so many by (chrom, bin)
    and the point's bin stays in the result as ``BIN``, so that what is grouped by the
    chromosome and this bin among others need not be shuffled again.
    """
    same = point_chrom == interval_chrom
    iv = intervals.withColumnRenamed(interval_chrom, "_ichrom") if same else intervals
    ichrom = "_ichrom" if same else interval_chrom
    if bin_size is None:
        p = points
        iv = iv.filter(F.col(end) > F.col(start))
        cond = ((p[point_chrom] == iv[ichrom]) & (p[point_pos] >= iv[start])
                & (p[point_pos] < iv[end]))
    elif not isinstance(bin_size, int):
        if how != "inner":
            raise ValueError("bins of several sizes are for inner joins: a point is looked for in each")
        levels = _levels_in_use(iv, start, end, bin_size) or [0]
        p = points.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels])))
        p = p.withColumn("_bin", F.floor(F.col(point_pos) / _size_of(F.col("_level"), bin_size)).cast("bigint"))
        p = p.withColumn("_part", _part_of(F.col(point_pos), F.col("_level"), bin_size))
        iv = _with_parts(nested_bins(iv, start, end, bin_size, "_ibin", "_ilevel"), start, end, bin_size)
        cond = ((p[point_chrom] == iv[ichrom]) & (p["_level"] == iv["_ilevel"]) & (p["_bin"] == iv["_ibin"])
                & (p["_part"] == iv["_ipart"]) & (p[point_pos] >= iv[start]) & (p[point_pos] < iv[end]))
    else:
        p = points.withColumn("_bin", bin_of(F.col(point_pos), bin_size))
        iv = interval_bins(iv, start, end, bin_size, "_ibin")
        cond = ((p[point_chrom] == iv[ichrom]) & (p["_bin"] == iv["_ibin"])
                & (p[point_pos] >= iv[start]) & (p[point_pos] < iv[end]))
    if partitions is not None:
        if not isinstance(bin_size, int):
            raise ValueError("partitions are by bins of one size")
        p, iv = p.repartition(partitions, point_chrom, "_bin"), iv.repartition(partitions, ichrom, "_ibin")
        return p.hint("merge").join(iv, cond, how).withColumnRenamed("_bin", BIN).drop("_ibin", "_ichrom")
    small = broadcast_if_small(iv, broadcast_bytes)
    if small is iv:
        p = p.hint("merge")
    out = p.join(small, cond, how)
    if bin_size is not None:
        out = out.drop("_bin", "_ibin", "_level", "_ilevel", "_part", "_ipart")
    return out.drop("_ichrom") if same else out
