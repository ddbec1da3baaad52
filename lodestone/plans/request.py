"""A whole search request over one table: match, rank, collapse, page, group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import highlight
from lodestone.operators import grouping, order, ranking
from lodestone.sources.tables import DocType, columns_of


@dataclass(frozen=True)
class Request:
    """``where`` None matches everything; ``recall`` and ``filter`` never touch the score."""

    where: Column | None = None
    recall: Column | None = None
    filter: Column | None = None
    location: tuple[str, object] | None = None
    selection: str | None = None
    profile: ranking.RankProfile | None = None
    inputs: Mapping[str, object] = field(default_factory=dict)
    sorting: str | Sequence[Column] | None = None
    hits: int = 10
    offset: int = 0
    collapse_field: str | None = None
    collapse_size: int = 1
    summary: str | None = None
    bold: Mapping[str, Sequence[str]] = field(default_factory=dict)
    levels: Sequence[grouping.Level] = ()


@dataclass
class Response:
    """Lazy tables; nothing runs before an action on one of them."""

    hits: DataFrame
    total: DataFrame
    groups: list[DataFrame]


def search(df: DataFrame, doc: DocType, req: Request) -> Response:
    for name, value in [req.location] if req.location else []:
        df = df.where(F.col(name) == F.lit(value))
    if req.selection:
        df = df.where(F.expr(req.selection))
    for c in (req.filter, req.recall, req.where):
        if c is not None:
            df = df.where(c)
    all_columns = df.columns
    matched = ranking.rank(df, doc.key, req.profile, req.inputs) if req.profile else df.withColumn("relevance", F.lit(0.0))
    if isinstance(req.sorting, str):
        by = [*order.sort_spec(req.sorting), F.col(doc.key)]
    elif req.sorting:
        by = [*req.sorting, F.col(doc.key)]
    elif req.profile:
        by = ranking.phase_order(doc.key)
    else:
        by = order.by_relevance(matched, doc.key)
    page = matched
    if req.collapse_field:
        page = order.collapse(page, req.collapse_field, by, req.collapse_size)
    page = order.hits(page, by, req.hits, req.offset)
    for c, terms in req.bold.items():
        page = page.withColumn(c, highlight(c, terms))
    shown = columns_of(doc, req.summary, all_columns)
    extra = [c for c in ("relevance", "match_features") if c in page.columns]
    return Response(
        hits=page.select(*shown, *extra),
        total=order.match_count(matched),
        groups=grouping.nested_groups(matched, req.levels) if req.levels else [],
    )
