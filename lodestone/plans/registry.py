"""Named queries over the given tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The tables of one data folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class Query(NamedTuple):
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return register


def simple(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    query(name, sql)(build)


# -- SQL fragments of the twins ----------------------------------------------------------------


def sql_tokens(c: str) -> str:
    return rf"list_filter(string_split_regex({c}, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


TOK = sql_tokens("lower(text)")

