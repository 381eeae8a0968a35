"""Tab-separated text scans: VCF, GTF and VEP ``--tab`` output.

All three are read with ``spark.read.text`` and split on tabs, so a file is
split across tasks when its codec allows it. A ``.gz`` file is one task there;
``split_bytes`` reads it in ranges instead, which spreads block-gzip files (what
``bgzip`` writes) over many tasks (``vartab.sources.blocks``). For other gzip files
pass ``partitions`` to spread the rows right after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vartab.functions import null_tokens
from vartab.sources.blocks import read_blocks
from vartab.sources.discovery import all_reachable, column_header, group_files


# Compressions Spark does not unpack by extension: it would read them as text.
_UNREADABLE = (".bgz", ".bgzf", ".zip", ".xz", ".7z", ".tar", ".tgz")


def _body(spark: SparkSession, path, comment: str = "#", split_bytes: int | None = None) -> DataFrame:
    if split_bytes:
        lines = read_blocks(spark, path, split_bytes)
    else:
        lines = spark.read.text(path)
        bad = [f for f in lines.inputFiles() if f.lower().endswith(_UNREADABLE)]
        if bad:
            raise ValueError(f"unsupported compression (use .gz, or split_bytes for block-gzip): {bad[0]}")
    return lines.filter(~F.col("value").startswith(comment) & (F.col("value") != ""))


def _cols(parts, spec):
    return [F.get(parts, i).alias(name) for i, name in spec]


def read_vcf(spark: SparkSession, path, partitions: int | None = None,
             keep_line: bool = False, split_bytes: int | None = None) -> DataFrame:
    """VCF data lines -> (variant_id, chrom, start, ref, alt, info).

    Lines starting with ``#`` are header/comment lines; a ``#`` later in a
    line is data. ``start`` is 0-based (POS - 1) and cast strictly.
    ``keep_line`` adds the raw ``line`` (all columns, samples included) for
    verbatim re-export; column pruning drops it wherever it is not used.
    ``split_bytes``: the files are gzip, read in ranges of about so many bytes.
    """
    p = F.split(F.col("value"), "\t", 9)  # FORMAT and the samples stay one field
    cols = [
        F.get(p, 2).alias("variant_id"),
        F.get(p, 0).alias("chrom"),
        (F.get(p, 1).cast("bigint") - F.lit(1)).alias("start"),
        F.get(p, 3).alias("ref"),
        F.get(p, 4).alias("alt"),
        F.get(p, 7).alias("info"),
    ]
    if keep_line:
        cols.append(F.col("value").alias("line"))
    df = _body(spark, path, split_bytes=split_bytes).select(*cols)
    return df.repartition(partitions) if partitions else df


def read_vcf_header(spark: SparkSession, path, probe: int = 1000) -> list[str]:
    """The ``#`` header lines at the top of the first input file.

    Reads only the top of the file: ``limit(k)`` with k doubling until a
    data line shows up or the file ends, never a scan of the whole input.
    Only header lines reach the driver; of a data line just that it is one."""
    files = sorted(spark.read.text(path).inputFiles())
    if not files:
        return []
    k = probe
    lines = spark.read.text(files[0]).select(
        F.when(F.col("value").startswith("#"), F.col("value")).alias("value"))
    while True:
        top = [r["value"] for r in lines.limit(k).collect()]
        if None in top:
            return top[:top.index(None)]
        if len(top) < k:
            return top
        k *= 4


GTF_COLUMNS = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame",
               "attributes"]


def read_gtf(spark: SparkSession, path, feature: str | None = None,
             partitions: int | None = None, keep_line: bool = False, split_bytes: int | None = None) -> DataFrame:
    """GTF lines -> 9 named columns (1-based inclusive start/end as bigint),
    optionally only one feature type (``transcript``, ``gene``, ``exon``).
    ``keep_line`` adds the raw ``line`` for verbatim re-export; ``split_bytes`` as
    in ``read_vcf``."""
    p = F.split(F.col("value"), "\t", -1)
    cols = []
    for i, name in enumerate(GTF_COLUMNS):
        c = F.get(p, i)
        if name in ("start", "end"):
            c = c.try_cast("bigint")
        cols.append(c.alias(name))
    if keep_line:
        cols.append(F.col("value").alias("line"))
    df = _body(spark, path, split_bytes=split_bytes).select(*cols)
    if feature is not None:
        df = df.filter(F.col("feature") == feature)
    return df.repartition(partitions) if partitions else df


def _vep_header(spark: SparkSession, path) -> list[tuple[list[str], list[str]]]:
    """Column-header row (``#Uploaded_variation ...``) of each file, grouped.

    One job: its tasks read the top of every file, up to the header or the first data
    line. (In a store that tasks can't open by themselves, one small job per file.) A
    file without a header line (a later part file of a folder written in parts) takes
    the header of its folder, which must then have exactly one."""
    files = spark.read.text(path).inputFiles()
    by_file: dict[str, str | None] = {}
    if all_reachable(files):
        by_file = {f: h for h, fs in group_files(spark, files, column_header).items() for f in fs}
    else:
        for f in files:
            row = (spark.read.text(f)
                   .filter(F.col("value").startswith("#") & ~F.col("value").startswith("##"))
                   .limit(1).collect())
            by_file[f] = row[0]["value"] if row else None
    in_folder: dict[str, set[str]] = {}
    for f, h in by_file.items():
        if h is not None:
            in_folder.setdefault(f.rsplit("/", 1)[0], set()).add(h)
    groups: dict[str, list[str]] = {}
    for f, h in by_file.items():
        if h is None:
            known = in_folder.get(f.rsplit("/", 1)[0], set())
            if len(known) != 1:
                raise ValueError(f"{'no' if not known else 'more than one'} '#Uploaded_variation' "
                                 f"header in the folder of {f}")
            (h,) = known
        groups.setdefault(h, []).append(f)
    return [(h.split("\t"), files) for h, files in groups.items()]


def read_vep_tab(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    """VEP tab output -> one string column per header field.

    ``##`` lines are skipped; the ``#Uploaded_variation`` header names the
    columns and its first name becomes ``Uploaded_variation``; ``-`` and
    empty fields are NULL; extra fields on a ragged line are dropped and
    missing ones are NULL. Files with different headers are read per header
    and unioned by name.
    """
    headers = _vep_header(spark, path)
    if not headers:
        raise ValueError(f"no '#Uploaded_variation' header line in {path}")
    frames = []
    for names, files in headers:
        names = [names[0].lstrip("#")] + names[1:]
        src = path if len(headers) == 1 else files
        p = F.split(F.col("value"), "\t", -1)
        frames.append(_body(spark, src).select(
            *[null_tokens(F.get(p, i)).alias(n) for i, n in enumerate(names)]))
    df = frames[0]
    for other in frames[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    return df.repartition(partitions) if partitions else df
