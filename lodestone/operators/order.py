"""Order, limits, numbering of whole results, paging and collapse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.scalars import uca
from lodestone.functions.text import as_col
from lodestone.session import cut, range_count

# Most rows a top-k may gather in one task.
ONE_TASK_ROWS = 1_000_000


def sort_spec(spec: str) -> list[Column]:
    """``"+year -relevance"`` -> order columns; no sign means ascending."""
    out = []
    for part in spec.split():
        name = part.lstrip("+-")
        out.append(F.col(name).desc() if part.startswith("-") else F.col(name).asc())
    return out


def order_by(df: DataFrame, *fields: str | tuple[str, bool] | Column) -> DataFrame:
    """Several fields; a tuple ``(field, True)`` is descending."""
    cols = [
        f if isinstance(f, Column) else F.col(f[0]).desc() if isinstance(f, tuple) and f[1] else F.col(f if isinstance(f, str) else f[0])
        for f in fields
    ]
    return df.orderBy(*cols)


def locale_order(field: str, locale: str, strength: str | None = None, descending: bool = False) -> Column:
    key = uca(field, locale, strength)
    return key.desc() if descending else key.asc()


def top(df: DataFrame, order: Sequence[Column], n: int, offset: int = 0) -> DataFrame:
    """Best ``n`` rows: every task keeps a bounded heap, nothing is sorted whole.

    More rows than one task should hold are taken by their position instead, and stay
    spread out.  Otherwise the rows are in one partition already, so ``coalesce`` costs nothing; it keeps later
    projections from being moved below the limit, where they would run on every row and
    turn the heap into a full sort.
    """
    if n + offset > ONE_TASK_ROWS:
        at = F.col("_position")
        return number_rows(df, order, "_position").where((at >= offset) & (at < offset + n)).drop("_position")
    out = df.orderBy(*order)
    return (out.offset(offset) if offset else out).limit(n).coalesce(1)


def hits(df: DataFrame, order: Sequence[Column], hits: int = 10, offset: int = 0) -> DataFrame:
    """One result page."""
    return top(df, order, hits, offset)


def by_relevance(df: DataFrame, key: str, score: str = "relevance") -> list[Column]:
    """The default order: score descending, then id."""
    return [F.col(score).desc_nulls_last(), F.col(key).asc()]


def with_position(page: DataFrame, order: Sequence[Column], name: str = "hit_rank", start: int = 1) -> DataFrame:
    """Positions inside one already limited page."""
    return page.withColumn(name, F.row_number().over(Window.orderBy(*order)) + F.lit(start - 1))


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Position (from 0) of every row in a total order, without one task seeing all rows.

    Rows are range-partitioned and sorted once and cut to reliable storage; each
    partition then only needs the count of the partitions before it.  ``order`` must end
    in a unique key, so that no value can fill a partition alone.  There are as many ranges
    as the rows' bytes need.
    """
    ranged = df.repartitionByRange(range_count(df), *order).sortWithinPartitions(*order)
    ranged = cut(ranged.withColumn("_seq", F.monotonically_increasing_id()))
    # monotonically_increasing_id: partition number above bit 33, row number below
    part = F.shiftright("_seq", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    # at most one row per partition, so its size is bounded by the partition count
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_seq", "_part", "_start")
    )


def pages(df: DataFrame, order: Sequence[Column], page_size: int = 100) -> DataFrame:
    """Every row with its ``page`` and ``position``: a paged search in one job."""
    out = number_rows(df, order)
    return out.withColumn("page", F.floor(F.col("position") / page_size))


def page_after(df: DataFrame, key: str, last, page_size: int = 100) -> DataFrame:
    """The page after ``last`` in key order (``None``: the first); a pushed-down seek."""
    rest = df if last is None else df.where(F.col(key) > F.lit(last))
    return top(rest, [F.col(key).asc()], page_size)


def hit_stream(df: DataFrame, order: Sequence[Column]):
    """All matches in order, one partition at a time in the reader's memory."""
    return df.orderBy(*order).toLocalIterator(prefetchPartitions=True)


def match_count(df: DataFrame) -> DataFrame:
    """Matches before any limit, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("total_count"))


def collapse(df: DataFrame, field: str | Column, order: Sequence[Column], size: int = 1) -> DataFrame:
    """Best ``size`` hits per field value.

    The rank filter becomes a group limit before the shuffle, so a hot value sends at
    most ``size`` rows per task.
    """
    w = Window.partitionBy(as_col(field)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= size).drop("_rn")
