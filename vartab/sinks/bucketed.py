"""Score tables bucketed by site, so that lookups never shuffle them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.operators.scores import SITE_KEYS, site_keys
from vartab.session import shuffles_dropped
from vartab.sources.bucketed import LAYOUT, bucketed_name

BUCKETS = 1024


def write_bucketed_scores(scores: DataFrame, path: str, buckets: int = BUCKETS, strip_chr: bool = False,
                          columns: Sequence[str] | None = None) -> None:
    """Writes a score table in ``buckets`` files by hash of the site (chrom, start, ref,
    alt), each sorted by chromosome and position. One shuffle at this point spares every
    later lookup the shuffle of the table: its join deals only the sites, to as many
    partitions (``sources.read_bucketed``, ``splice_lookup``, ``lookup_scores``).

    The hash is over all keys of the lookup's join, which Spark's planner asks for
    before it leaves a side in place, and spreads a dense stretch of the genome over
    all buckets; sorted by position, a bucket's row groups are skipped by range. The
    keys are stored in the types that lookups compare (``strip_chr``: without ``chr``)."""
    spark = scores.sparkSession
    others = [c for c in (columns or scores.columns) if c not in SITE_KEYS]
    rows = scores.select(*site_keys(scores, strip_chr), *others)
    name = bucketed_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    with shuffles_dropped(spark):
        (rows.repartition(buckets, *SITE_KEYS).write.format("parquet").mode("overwrite").option("path", path)
         .bucketBy(buckets, *SITE_KEYS).sortBy("chrom", "start").saveAsTable(name))
    (spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1)
     .write.mode("overwrite").json(f"{path.rstrip('/')}/{LAYOUT}"))
