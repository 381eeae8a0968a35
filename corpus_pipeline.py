"""A corpus pipeline over ``documents``: five stages, each one of the operators
of ``vartab.llm``. Every stage works on all that its predecessor kept; all but
the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vartab.llm import bpe, decontam, jaccard, secrets, toxicity
from vartab.llm.common import stored, table
from vartab.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go (operator 9)."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near and exact copies the document with the least id stays (operator 7)."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go (operator 1)."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay (operator 8)."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes (operator 2), with a small
    cache, as the executors' heaps have grown in the stages before."""
    return bpe.round_trip(docs, vocabulary(cache_words=200_000, batch_bytes=2 << 20))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", mask_secrets), ("bpe", bpe_tokens)]
# learned weights, MinHash and latent spaces have no SQL; tests/llm hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to ``documents``; between stages the rows are stored, so a
    lost executor costs at most one stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
