"""Document ids ``id:<namespace>:<type>:<location>:<user part>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import as_col


def _parts(doc_id) -> tuple[Column, Column]:
    c = as_col(doc_id)
    parts = F.split(c, ":", 5)
    return parts, c.startswith("id:") & (F.size(parts) == 5)


def user_part(doc_id) -> Column:
    """Everything after the fourth colon; a bare id is its own user part."""
    parts, full = _parts(doc_id)
    return F.when(full, F.get(parts, F.lit(4))).otherwise(as_col(doc_id))


def id_parts(doc_id) -> dict[str, Column]:
    """namespace, doc_type, location and user_part columns (null parts for bare ids)."""
    parts, full = _parts(doc_id)
    at = lambda i: F.when(full, F.get(parts, F.lit(i)))
    return {"namespace": at(1), "doc_type": at(2), "location": at(3), "user_part": user_part(doc_id)}


def full_id(namespace: str, doc_type: str, key, location: Column | None = None) -> Column:
    """``location`` is empty, ``n=<number>`` or ``g=<group>``."""
    loc = F.lit("") if location is None else location
    return F.concat(F.lit(f"id:{namespace}:{doc_type}:"), loc, F.lit(":"), as_col(key).cast("string"))
