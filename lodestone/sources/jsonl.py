"""JSONL export and feed lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestone.functions.ids import full_id, user_part


def feed_lines(df: DataFrame, namespace: str, doc_type: str, key: str, location: Column | None = None) -> DataFrame:
    """One column ``value``: ``{"put": id, "fields": {..}}``, or ``{"remove": id}`` where ``_op`` says so."""
    doc_id = full_id(namespace, doc_type, F.col(key), location)
    fields = [c for c in df.columns if c not in ("_op", "_seq")]
    line = F.to_json(F.struct(doc_id.alias("put"), F.struct(*fields).alias("fields")))
    if "_op" in df.columns:
        line = F.when(F.col("_op") == "remove", F.to_json(F.struct(doc_id.alias("remove")))).otherwise(line)
    return df.select(line.alias("value"))


def write_jsonl(df: DataFrame, path: str, namespace: str, doc_type: str, key: str, compression: str = "gzip") -> None:
    feed_lines(df, namespace, doc_type, key).write.mode("overwrite").option("compression", compression).text(path)


def parse_lines(lines: DataFrame, fields: StructType) -> DataFrame:
    """Text lines -> ``id, key, _op`` and the fields.

    ``put`` and ``id`` lines are documents, ``remove`` lines tombstones with null fields;
    continuation tokens, other objects and malformed lines give no row.
    """
    envelope = StructType().add("put", "string").add("id", "string").add("remove", "string").add("fields", fields)
    j = F.from_json("value", envelope)
    doc = lines.select(j.alias("j")).select(
        F.coalesce("j.put", "j.id", "j.remove").alias("id"),
        F.when(F.coalesce("j.put", "j.id").isNotNull(), "put").when(F.col("j.remove").isNotNull(), "remove").alias("_op"),
        "j.fields",
    )
    doc = doc.where(F.col("_op").isNotNull())
    live = F.col("_op") == "put"
    return doc.select(
        "id", user_part("id").alias("key"), "_op",
        *[F.when(live, F.col(f"fields.{f.name}")).alias(f.name) for f in fields.fields],
    )


def read_jsonl(spark: SparkSession, path: str, fields: StructType) -> DataFrame:
    return parse_lines(spark.read.text(path), fields)
