"""Sharding by a keyed permutation of global row numbers (operator 10).

Rows get gapless global numbers 0..n-1; a Feistel network over a domain just
above n, with cycle walking back into [0, n), permutes them. Position p of the
permutation is shard ``p mod shards``, slot ``p div shards``: shard counts
differ by at most one (law ``rows``), slots are gapless from 0, and both follow
from the row number and the key alone.

All steps are DataFrame functions. The number of a row is its rank by (bucket,
doc_id, size, checksum); buckets are a hash of those columns, so no sort spans
the table: one window per bucket, plus the running sum of the bucket totals,
whose row count is the constant ``BUCKETS``. Equal rows are counted before the
shuffle and expanded afterwards, so a row repeated any number of times is not
shuffled or sorted more than once; the task that has it writes out its copies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vartab.llm.common import stored, text_or_empty

ROUNDS = 6
WALKS = 40
BUCKETS = 4096


def _div(x: Column, y: int) -> Column:
    return F.call_function("div", x, F.lit(y).cast("long"))


def _keyed(value: Column, key: str, rnd: int) -> Column:
    """The round function: 60 bits of md5(key:round:value), as a long."""
    digest = F.md5(F.concat(F.lit(f"{key}:{rnd}:"), value.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def domain(n: int) -> tuple[int, int]:
    """Sides (a, b) of a near-square domain with n <= a * b < n + a."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def feistel(x: Column, a: int, b: int, key: str) -> Column:
    """One pass of the network over Z_a x Z_b (x = left + a * right). Each round
    adds the keyed other half to one half, a bijection for any a and b."""
    left, right = x % F.lit(a).cast("long"), _div(x, a)
    for r in range(ROUNDS):
        if r % 2 == 0:
            left = (left + _keyed(right, key, r) % a) % a
        else:
            right = (right + _keyed(left, key, r) % b) % b
    return left + right * F.lit(a).cast("long")


def permute(number: Column, n: int, key: str) -> Column:
    """The place of row ``number`` (0..n-1) in the keyed order of n rows.

    Fewer than a of the a * b >= n places lie beyond n, so a walk of WALKS steps
    that never comes back has odds of about n ** (-WALKS / 2); it would raise."""
    a, b = domain(n)
    first = feistel(number, a, b, key)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(WALKS, a))), first,
        lambda at, _: F.when(at >= n, feistel(at, a, b, key)).otherwise(at))
    at = F.when(first < n, first).otherwise(walked)
    return F.when(at < n, at).otherwise(
        F.raise_error(F.lit("cycle walk did not return; choose another key")).cast("long"))


def numbered(counted: DataFrame, columns: list[str], buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """Adds ``_first``, the global number of the first copy of each distinct row,
    to a stored table of distinct rows with ``_copies`` and ``_bucket``."""
    totals = counted.groupBy("_bucket").agg(F.sum("_copies").alias("_total"))
    n = totals.agg(F.sum("_total")).first()[0] or 0
    # at most `buckets` rows, whatever the size of the table
    starts = totals.select("_bucket", (F.sum("_total").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_total")).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in columns]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    out = (counted.withColumn("_upto", F.sum("_copies").over(within))
           .join(F.broadcast(starts), "_bucket")
           .withColumn("_first", F.col("_start") + F.col("_upto") - F.col("_copies")))
    return out, int(n)


def shard_rows(docs: DataFrame, shards: int = 24, key: str = "shard-1", id_col: str = "doc_id",
               text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Shard and slot of every row, shuffled reproducibly by ``key``.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law
    (``rows``), row_number, shard, slot, grown_shard (null: no growth law).
    Other columns of the input are not read, whatever their names. Defined
    cases: a null text counts as no bytes; null and repeated doc_ids are rows
    like any other, each with its own place; equal rows (same id, size and
    checksum) take consecutive row numbers; an empty table gives no rows. Texts
    are only measured, so their length does not matter.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    data = F.encode(text_or_empty(text_col), "UTF-8")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty(text_col)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"))
    columns = ["doc_id", "size", "text_crc32"]
    ident = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    bucket = (F.conv(F.substring(F.md5(ident.cast("binary")), 1, 8), 16, 10).cast("long") % buckets).cast("int")
    counted = stored(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
                     .withColumn("_bucket", bucket), "shard-rows")
    placed, n = numbered(counted, columns, buckets)
    numbers = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1))
    out = placed.select(*columns, numbers.alias("row_number"))
    place = permute(F.col("row_number"), n, key) if n else F.lit(0).cast("long")
    return (out.withColumn("_place", place)
            .select(*columns, F.lit("rows").alias("law"), "row_number",
                    (F.col("_place") % shards).cast("int").alias("shard"),
                    _div(F.col("_place"), shards).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
