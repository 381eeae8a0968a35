"""Connected components by alternating stars, on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.session import drop_path, work_dir


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the least node
    of its component, by the order of the node type.

    Each round hangs the larger neighbours of every node on its least neighbour
    (large star), then all on the least of the smaller ones (small star); both
    are a partially aggregated minimum and a join on the node. Rounds, of which
    there are about log(size of a component) squared, end when a round changes
    nothing; each is written out, so none is recomputed after a loss, and the
    round before is dropped. A hub's edges meet its one minimum in a sort-merge join
    of two stored tables, which adaptive execution may split."""
    spark, paths = edges.sparkSession, {}

    def written(df: DataFrame, name: str = "edges") -> DataFrame:
        before, paths[name] = paths.get(name), work_dir(spark, name)
        df.write.parquet(paths[name])
        if before:
            drop_path(spark, before)
        return spark.read.schema(df.schema).parquet(paths[name])

    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = written(pairs)
    before = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.filter("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = large.distinct()
        # small star: every node of `large` is the greater end of its edges
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        pairs = written(small)
        now = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle; allow more rounds")
    drop_path(spark, paths["least"])
    labels = pairs.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
    roots = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.unionByName(roots)
