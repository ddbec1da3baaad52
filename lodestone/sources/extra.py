"""Undeclared JSON fields: caught in one map column, written back flat."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import as_col


def capture_extra(df: DataFrame, doc_column: str, declared: Mapping[str, str], into: str = "extra") -> DataFrame:
    """Declared fields (name -> type) as columns, every other one in ``map<string,string>``.

    Values of the map are JSON text, so that strings, numbers and objects round-trip.
    """
    doc = F.try_parse_json(doc_column)
    raw = F.try_variant_get(doc, "$", "map<string,variant>")
    names = F.array(*[F.lit(n) for n in declared]).cast("array<string>")
    rest = F.transform_values(
        F.map_filter(raw, lambda k, _: ~F.array_contains(names, k)), lambda _, v: F.to_json(v)
    )
    return df.withColumns(
        {**{n: F.try_variant_get(doc, f"$.{n}", t) for n, t in declared.items()}, into: rest}
    )


def flat_json(declared: Mapping[str, Column | str], extra: Column | str) -> Column:
    """The inverse: declared fields and the extra map as one flat JSON object."""
    parts = [F.concat(F.lit(json.dumps(n) + ":"), _value(as_col(c))) for n, c in declared.items()]
    more = F.transform(F.map_entries(as_col(extra)), lambda e: F.concat(_value(e["key"]), F.lit(":"), e["value"]))
    every = F.concat(F.filter(F.array(*parts), lambda p: p.isNotNull()), F.coalesce(more, F.array().cast("array<string>")))
    return F.concat(F.lit("{"), F.array_join(every, ","), F.lit("}"))


def _value(c: Column) -> Column:
    """JSON text of one value; null values leave the field out."""
    return F.when(c.isNotNull(), F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1))
