"""Registered queries of the pipeline operators, and their DuckDB SQL where SQL
can express them. Each query reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vartab.llm import (ann, bpe, decontam, html, jaccard, packing, quality, secrets, sharding, spelling, substrings,
                        toxicity, whitening)
from vartab.llm.common import table


def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken", **bounds: int) -> bpe.Vocabulary:
    return bpe.Vocabulary.load(public_tokenizers.path(name), public_tokenizers.PATTERN, **bounds)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: rows whose vec_id is divisible by 50, against all rows."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"))


def op5_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vocabulary()
    return packing.pack_tokens(table(spark, sf_dir, "documents"), v.ranks, v.pattern)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_bayes_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=24)


def op11_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_latent_decontamination, op2_byte_bpe, op3_multi_index_hashing, op4_substring_dedup, op5_packed_rows,
    op6_html_extraction, op7_bayes_jaccard, op8_secret_scan, op9_toxicity, op10_feistel_sharding,
    op11_factorisation_machine, op12_qdwh_whitening, op13_spelling_variants)}
