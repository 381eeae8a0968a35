"""Metrics that can be merged: sketches stored beside each part of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# HyperLogLog with 2**LOG_SIZE registers: 8 KB a column at most, a relative standard
# error of 1.04 / sqrt(2**LOG_SIZE), 0.8 percent.
LOG_SIZE = 14
METRICS = "_metrics"  # beside the data files; readers skip names with an underscore


def sketches(distinct: Sequence[str]) -> dict[str, Column]:
    """Aggregates to observe while a table is written (``write_parquet(metrics=...)``):
    a distinct-count sketch per column."""
    return {f"sketch_{c}": F.hll_sketch_agg(c, F.lit(LOG_SIZE)) for c in distinct}


def store_metrics(spark: SparkSession, path: str, found: dict, distinct: Sequence[str]) -> None:
    """Stores what ``write_parquet`` returned for the table at ``path`` beside its data:
    (column, rows, sketch)."""
    rows = [(c, found["rows"], bytearray(found[f"sketch_{c}"]) if found[f"sketch_{c}"] is not None else None) for c in distinct]
    (spark.createDataFrame(rows, "column string, rows long, sketch binary").coalesce(1)
     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/{METRICS}"))


def merged_metrics(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(column, rows, distinct_estimate) over several tables or runs, from their stored
    sketches alone: no data row is read, and a value in several tables counts once."""
    stored = spark.read.schema("column string, rows long, sketch binary").parquet(*[f"{p.rstrip('/')}/{METRICS}" for p in paths])
    return stored.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct_estimate"))
