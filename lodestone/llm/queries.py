"""The registered queries of this package: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import alignment, ann, decontamination, line_dedup, lm_scoring, merkle, mixing, ngram_join, quality, sharding, sql, token_counts, toxicity, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.without_repeated_runs(_table(spark, folder, "documents"))
    return out.select("doc_id", "text", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"))


def op2_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.ngram_scores(_table(spark, folder, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_copies(_table(spark, folder, "documents"), n=3, percent=90)


def op4_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_table(spark, folder, "embeddings"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(_table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(_table(spark, folder, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_uniform_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.uniform_shards(_table(spark, folder, "documents"))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    out = warc.archived(_table(spark, folder, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position")


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    a, b = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(_table(spark, folder, "documents"), a, b)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_lm_scores, op3_ngram_jaccard_join, op4_nearest_vectors, op5_mixing, op6_decontamination, op7_toxicity,
        op8_token_counts, op9_quality, op10_uniform_shards, op11_warc, op12_alignment, op13_merkle_manifest,
    )
}

SQL: dict[str, str] = {"op11_warc": sql.OP11, "op13_merkle_manifest": sql.OP13}
