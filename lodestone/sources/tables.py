"""Scans: one type, several types, bulk export, slices, time ranges, column subsets, keys, locations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import range_count, small_side


@dataclass(frozen=True)
class DocType:
    """What a document type needs beyond its columns: key, summaries, expiry, global flag."""

    name: str
    key: str
    summaries: Mapping[str, "Summary"] = field(default_factory=dict)
    expiry: str | None = None
    is_global: bool = False


@dataclass(frozen=True)
class Summary:
    """A named column list that may inherit another's columns."""

    fields: Sequence[str]
    inherits: str | None = None


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_types(tables: Mapping[str, DataFrame], restrict: Iterable[str] | None = None) -> DataFrame:
    """All types as one table with a ``_type`` column; unlisted types are not even scanned."""
    names = [n for n in tables if restrict is None or n in set(restrict)]
    if not names:
        raise ValueError("no document type left to search")
    out = None
    for n in names:
        t = tables[n].withColumn("_type", F.lit(n))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def columns_of(doc: DocType, spec: str | None, all_columns: Sequence[str]) -> list[str]:
    """Resolve ``type:f1,f2``, ``[all]`` / ``None`` or a summary class to column names."""
    if spec in (None, "*", "[all]", "[document]"):
        return list(all_columns)
    if spec in doc.summaries:
        s = doc.summaries[spec]
        parent = columns_of(doc, s.inherits, all_columns) if s.inherits else []
        return list(dict.fromkeys([*parent, *s.fields]))
    kind, sep, names = spec.partition(":")
    if not sep or kind != doc.name:
        raise ValueError(f"unknown column set {spec!r}")
    return [n.strip() for n in names.split(",")]


def visit(
    df: DataFrame,
    selection: str | Column | None = None,
    columns: Sequence[str] | None = None,
    *,
    key: str | None = None,
    slices: int | None = None,
    slice_id: int = 0,
    time_column: str | None = None,
    from_time=None,
    to_time=None,
    include_removes: bool = False,
) -> DataFrame:
    """Bulk export: selection, slice ``slice_id`` of ``slices``, ``[from, to)`` and columns.

    Tombstones (``_op = 'remove'``) are dropped unless asked for.
    """
    if time_column and from_time is not None:
        df = df.where(F.col(time_column) >= F.lit(from_time).cast(df.schema[time_column].dataType))
    if time_column and to_time is not None:
        df = df.where(F.col(time_column) < F.lit(to_time).cast(df.schema[time_column].dataType))
    if selection is not None:
        df = df.where(F.expr(selection) if isinstance(selection, str) else selection)
    if slices:
        df = df.where(slice_of(key, slices) == slice_id)
    if "_op" in df.columns:
        if not include_removes:
            df = df.where(F.col("_op") != "remove")
            df = df if columns else df.drop("_op")
    return df.select(*columns) if columns else df


def slice_of(key: str, slices: int) -> Column:
    """Slice number of a document: every document is in exactly one slice."""
    return F.pmod(F.xxhash64(key), F.lit(slices))


def get(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def get_many(df: DataFrame, key: str, ids: Iterable | DataFrame) -> DataFrame:
    """Documents with the given keys; absent keys give no row."""
    if not isinstance(ids, DataFrame):
        return df.where(F.col(key).isin(list(ids)))
    wanted = ids.select(F.col(ids.columns[0]).alias(key))
    return df.join(small_side(wanted), key, "left_semi")


# -- locations -------------------------------------------------------------------------------

LOCATION_BUCKETS = 256


def write_located(df: DataFrame, path: str, location: str, key: str, buckets: int = LOCATION_BUCKETS) -> None:
    """Store by location: folders of hashed locations, rows sorted by location inside.

    A hash keeps the folder count fixed however many users there are.  The write is spread
    over all tasks by location and ``key``, the document's own, so one hot location is cut
    into several files, as many in all as the bytes need.  The folder count is part of the layout, so readers need not know it.
    """
    layout = {"_location": F.col(location), "_buckets": F.lit(buckets), "_loc": slice_of(location, buckets).cast("int")}
    out = df.withColumns(layout)
    n = max(range_count(df), df.sparkSession.sparkContext.defaultParallelism)
    out.repartitionByRange(n, "_loc", "_location", key).sortWithinPartitions("_loc", "_location").write.partitionBy(
        "_buckets", "_loc"
    ).mode("overwrite").parquet(path)


def read_located(spark: SparkSession, path: str, location=None) -> DataFrame:
    """One location's documents: one folder is listed, its row groups pruned by the location."""
    df = spark.read.parquet(path)
    if location is not None:
        hashed = F.pmod(F.xxhash64(F.lit(location).cast(df.schema["_location"].dataType)), F.col("_buckets")).cast("int")
        df = df.where((F.col("_loc") == hashed) & (F.col("_location") == F.lit(location)))
    return df.drop("_buckets", "_loc", "_location")


def in_location(df: DataFrame, location: str, value, selection: str | Column | None = None) -> DataFrame:
    """Search inside one user or group, with an extra selection before matching."""
    df = df.where(F.col(location) == F.lit(value))
    if selection is not None:
        df = df.where(F.expr(selection) if isinstance(selection, str) else selection)
    return df
