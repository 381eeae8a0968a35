"""Reading score tables that ``sinks.write_bucketed_scores`` wrote."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LAYOUT = "_layout"  # beside the data files; readers skip names with an underscore


@dataclass
class BucketedScores:
    """A score table in ``buckets`` files by hash of (chrom, start, ref, alt)."""

    df: DataFrame
    buckets: int


def bucketed_name(path: str) -> str:
    """The catalog name of the table at ``path``."""
    return f"vartab_scores_{hashlib.md5(path.rstrip('/').encode()).hexdigest()[:16]}"


def is_bucketed(spark: SparkSession, path: str) -> bool:
    layout = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{LAYOUT}")
    return layout.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(layout)


def read_bucketed(spark: SparkSession, path: str) -> BucketedScores:
    """The table at ``path`` with its buckets known to the planner: an external table is
    registered in the catalog under a name made from the path, unless it is there."""
    root = path.rstrip("/")
    buckets = spark.read.schema("buckets int").json(f"{root}/{LAYOUT}").first()["buckets"]
    name = bucketed_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(root).schema.fields)
        location = root.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`chrom`, `start`, `ref`, `alt`) "
                  f"SORTED BY (`chrom`, `start`) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.catalog.refreshTable(name)  # a session beside this one may have written it anew
    return BucketedScores(spark.table(name), buckets)
