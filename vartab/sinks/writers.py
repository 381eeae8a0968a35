"""Parquet, hive-partitioned and text writers, and run metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vartab.session import drop_path, shuffles_dropped, work_dir
from vartab.sources.blocks import write_blocks

PARTITION_COLUMNS = ("variant_type", "gene_type", "canonical")


def _counted(df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Row count and ``metrics`` observed while the write runs (no second pass)."""
    obs = Observation(name)
    more = [c.alias(k) for k, c in (metrics or {}).items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *more), obs


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  metrics: Mapping[str, Column] | None = None, compression: str | None = None) -> dict:
    """One flat part table. Returns the observed row count, and the observed
    values of ``metrics`` (aggregates other than DISTINCT ones)."""
    out, obs = _counted(df, "parquet", metrics)
    w = out.write.mode(mode)
    with shuffles_dropped(df.sparkSession):
        (w.option("compression", compression) if compression else w).parquet(path)
    return dict(obs.get)


def write_annotations(df: DataFrame | Sequence[DataFrame], path: str, partition_by: Sequence[str] = PARTITION_COLUMNS,
                      max_records_per_file: int | None = 5_000_000) -> dict:
    """Hive-partitioned write with a clean rebuild of ``path``.

    ``REBALANCE`` on the partition columns lets adaptive execution split a
    dominant partition (SNV / protein_coding) over many tasks and merge tiny
    ones, instead of one task per partition value. ``maxRecordsPerFile``
    bounds file size. Static overwrite deletes stale partitions first.
    Several frames (the passes of ``annotation_passes``) are written one after another,
    so that only the shuffles of one are on disk at a time.
    Returns row counts observed during the write.
    """
    rows = 0
    for k, frame in enumerate([df] if isinstance(df, DataFrame) else df):
        out, obs = _counted(frame.hint("rebalance", *partition_by), "annotations")
        w = out.write.mode("append" if k else "overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        with shuffles_dropped(frame.sparkSession):
            w.parquet(path)
        rows += obs.get["rows"]
    return {"rows": rows}


def write_ids(ids: DataFrame, path: str) -> dict:
    """Headerless one-column id list (one id per line)."""
    out, obs = _counted(ids.select(F.col(ids.columns[0]).cast("string")), "ids")
    with shuffles_dropped(ids.sparkSession):
        out.write.mode("overwrite").text(path)
    return dict(obs.get)


def _tab_line(*cols) -> Column:
    """Fields joined by tabs; a missing one is '.', so none shifts."""
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit(".")) for c in cols])


def _vcf_line() -> Column:
    return _tab_line(F.col("chrom"), F.col("start") + 1, F.col("variant_id"), F.col("ref"),
                     F.col("alt"), F.lit("."), F.lit("."), F.col("info"))


def vcf_lines(vcf: DataFrame) -> DataFrame:
    """VCF data lines: the raw input ``line`` when the rows carry it (a
    verbatim subset, samples included), else rebuilt from (variant_id,
    chrom, start, ref, alt, info) with QUAL and FILTER as '.'."""
    return vcf.select((F.col("line") if "line" in vcf.columns else _vcf_line()).alias("value"))


def write_text(lines: DataFrame, header: Sequence[str], path: str,
               compression: str | None = None) -> None:
    """Text lines (column ``value``) with ``header`` lines in the first part
    file, so the part files in name order concatenate to one valid file.
    ``compression="blocks"`` writes block-gzip files, which are read in ranges."""
    spark = lines.sparkSession
    head = spark.createDataFrame([(h,) for h in header], "value string").coalesce(1)
    whole = head.union(lines.select("value"))
    with shuffles_dropped(spark):
        if compression == "blocks":
            write_blocks(whole, path)
            return
        w = whole.write.mode("overwrite")
        if compression:
            w = w.option("compression", compression)
        w.text(path)


def write_vcf(vcf: DataFrame, header: Sequence[str], path: str, compression: str = "gzip",
              sort: bool = True, staged: bool = False) -> dict:
    """VCF text (header first). ``sort`` orders the data by (chrom, start)
    with a sampled range partitioning, never a single task. ``staged`` stores the rows
    before they are sorted, for rows that come of a shuffle: its files are then gone before
    those of the sort are made. Returns the observed number of data lines."""
    spark, rows_path = vcf.sparkSession, None
    if staged and sort:
        rows_path = work_dir(spark, "vcf-rows")
        write_parquet(vcf, rows_path, compression="zstd")
        vcf = spark.read.schema(vcf.schema).parquet(rows_path)
    body, obs = _counted(sort_by_position(vcf) if sort else vcf, "vcf")
    write_text(vcf_lines(body), header, path, compression)
    if rows_path:
        drop_path(spark, rows_path)
    return dict(obs.get)


def write_chunks(df: DataFrame, path: str, rows_per_chunk: int = 500_000) -> dict:
    """Fixed-size chunks: every file holds at most ``rows_per_chunk`` rows."""
    out, obs = _counted(df, "chunks")
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_chunk).parquet(path)
    return dict(obs.get)


def sort_annotation(gtf: DataFrame, header: Sequence[str], path: str,
                    chrom: str = "seqname", start: str = "start") -> dict:
    """Coordinate-sorted gene-model text export (comments first, then lines
    ordered by chromosome text and numeric start), gzip-compressed. Lines
    are the input's own when the rows carry ``line``, else rebuilt."""
    body, obs = _counted(sort_by_position(gtf, chrom, start), "sorted")
    line = F.col("line") if "line" in gtf.columns else _tab_line(*[F.col(c) for c in gtf.columns])
    lines = body.select(line.alias("value"))
    write_text(lines, header, path, compression="gzip")
    return dict(obs.get)


def sort_by_position(df: DataFrame, chrom: str = "chrom", start: str = "start") -> DataFrame:
    """Global coordinate order (chrom text, start numeric) by range
    partitioning; part files in name order are in genome order."""
    return df.repartitionByRange(chrom, start).sortWithinPartitions(chrom, start)


def run_metrics(df: DataFrame, distinct: Sequence[str] = (),
                flags: Sequence[str] = ()) -> DataFrame:
    """One-row table: row count, distinct counts and true-counts of flags. Every
    distinct count is an aggregate of its own over one pruned column (several in one
    aggregate would multiply the rows), so pass a stored or cheap table."""
    counts = {"n_rows": F.count(F.lit(1)), **{f"n_{c}": F.count_if(F.col(c)) for c in flags}}
    found = [df.agg(*[v.alias(k) for k, v in counts.items()])]
    found += [df.agg(F.count_distinct(c).alias(f"distinct_{c}")) for c in distinct]
    names = ["n_rows", *[f"distinct_{c}" for c in distinct], *[f"n_{c}" for c in flags]]
    whole = found[0]
    for one in found[1:]:
        whole = whole.unionByName(one, allowMissingColumns=True)
    return whole.agg(*[F.max(c).alias(c) for c in names])


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Distinct values per column of a stored table, one pruned scan each:
    several DISTINCTs in one aggregate would multiply its rows instead."""
    with shuffles_dropped(df.sparkSession):
        return {c: df.select(c).distinct().count() for c in cols}


def compact_scores(scores: DataFrame, path: str, chrom: str = "chrom", start: str = "start",
                   max_records_per_file: int = 20_000_000) -> None:
    """Rewrite a score source spread over many small files (one per gene) once
    as a table partitioned by chromosome and sorted by position: a range
    partitioning (sampled) makes each task own a contiguous stretch, so it
    writes few large files, and Parquet min/max statistics on ``start``
    let later lookups skip row groups."""
    with shuffles_dropped(scores.sparkSession):
        (sort_by_position(scores, chrom, start).write.mode("overwrite")
         .option("maxRecordsPerFile", max_records_per_file).partitionBy(chrom).parquet(path))


def number_rows(rows: DataFrame, mid: str, number: str) -> DataFrame:
    """``rows`` (stored, with the ``monotonically_increasing_id`` they were written under
    in ``mid``) numbered without gaps in that order: one pass counts the rows of each
    partition, their prefix sums (one number per task) are broadcast."""
    part = F.shiftright(F.col(mid), 33).cast("int")
    with shuffles_dropped(rows.sparkSession):
        counts = sorted((r["_part"], r["count"]) for r in rows.groupBy(part.alias("_part")).count().collect())
    offsets, before = [], 0
    for k, n in counts:
        offsets.append((k, before))
        before += n
    table = rows.sparkSession.createDataFrame(offsets, "_part int, _before long")
    own = F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.withColumn("_part", part).join(F.broadcast(table), "_part")
            .withColumn(number, F.col("_before") + own).drop("_part", "_before"))


def write_vcf_chunks(vcf: DataFrame, header: Sequence[str], path: str,
                     rows_per_chunk: int = 500_000, compression: str | None = None) -> dict:
    """Standalone VCF chunk files: every chunk folder (``chunk=<k>``, k from 0)
    holds one text file with the header lines followed by ``rows_per_chunk`` data
    lines, in the order of ``vcf`` (its partitions one after another); only the last
    chunk holds fewer.

    The lines are stored first, with their partition and place in it, so a retried
    task sees the same rows in the same order, and then numbered
    (``number_rows``); a line's chunk is its number div ``rows_per_chunk``. No task
    holds more than a chunk. ``compression="gzip"`` packs the chunk files. Returns the
    observed number of data lines.
    """
    spark = vcf.sparkSession
    counted, obs = _counted(vcf_lines(vcf), "vcf_chunks")
    lines_path = work_dir(spark, "chunk-lines")
    with shuffles_dropped(spark):
        counted.withColumn("_mid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(lines_path)
    total = obs.get["rows"]
    rows = number_rows(spark.read.schema("value string, _mid long").parquet(lines_path), "_mid", "_number")
    n = F.lit(rows_per_chunk)
    data = rows.select(F.expr(f"_number div {rows_per_chunk}").alias("chunk"), (F.col("_number") % n).alias("pos"), "value")
    lines = F.array(*[F.struct(F.lit(i - len(header)).cast("long").alias("pos"), F.lit(h).alias("value")) for i, h in enumerate(header)])
    if header:
        tops = (spark.range(-(-total // rows_per_chunk)).select(F.col("id").alias("chunk"), F.explode(lines).alias("h"))
                .select("chunk", "h.pos", "h.value"))
        data = data.unionByName(tops)
    w = data.repartition("chunk").sortWithinPartitions("chunk", "pos").select("chunk", "value").write.mode("overwrite").partitionBy("chunk")
    with shuffles_dropped(data.sparkSession):
        (w.option("compression", compression) if compression else w).text(path)
    drop_path(spark, lines_path)
    return {"rows": total}
