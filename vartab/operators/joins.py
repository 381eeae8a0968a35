"""Join helpers: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vartab.session import shuffles_dropped

# Largest side (bytes of its values) that is ever hinted for broadcast.
# A gene map (~60k rows) fits far below it; transcript metadata (~250k rows) about.
# The driver holds a broadcast as rows, as a hash table and as its serialized pieces,
# three to four times these bytes together, and a query may have several.
BROADCAST_MAX_BYTES = 32 << 20
_ROW_OVERHEAD = 32
_SLICES = 64


def _value_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df`` with a row overhead: sums per task, then
    per slice of the tasks; the driver adds up at most ``_SLICES`` numbers and
    no task gets more than one number per input task."""
    size = F.lit(_ROW_OVERHEAD).cast("bigint")
    for field in df.schema.fields:
        size = size + _value_bytes(field)
    with shuffles_dropped(df.sparkSession):
        rows = (df.select(F.pmod(F.spark_partition_id(), F.lit(_SLICES)).alias("slice"), size.alias("size"))
                .groupBy("slice").agg(F.sum("size").alias("size")).collect())
    return sum(r["size"] or 0 for r in rows)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the measured size is at most ``max_bytes``.

    Measuring runs the plan of ``df`` once, so pass stored or cheap sides.
    Beyond the bound the side is returned as is and the planner shuffles
    it (adaptive execution may still broadcast it from measured sizes).
    ``max_bytes=None`` skips the check and never hints.
    """
    if max_bytes is None:
        return df
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df
