"""The training-data pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import decontamination, mixing, ngram_join, sharding, toxicity
from lodestone.llm.common import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labels of the documents that are left."""
    return toxicity.reject_toxic(docs, _table(spark, sf_dir, "labels")).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 or more of its five-word shingles."""
    return ngram_join.drop_near_copies(docs, n=5, percent=80).select(*COLUMNS)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics have their target shares of the tokens."""
    return mixing.sample(docs).select(*COLUMNS)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    return sharding.uniform_shards(docs, keep=["text", "lang", "source", "n_chars"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_test_items),
    ("mixing sources to target weights", to_target_weights),
    ("sharding", in_shards),
]

#: Learned weights and drawn samples have no SQL form; each stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what stands between two of them is a table in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"stage-{name.replace(' ', '-')}")
    return docs
