"""Parent fields shown on the child through a reference."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import small_side


def import_fields(
    child: DataFrame, reference: str, parent: DataFrame, parent_key: str, fields: Mapping[str, str],
    global_parent: bool = False,
) -> DataFrame:
    """``fields`` maps alias -> parent column.  A child without parent keeps null aliases.

    A global parent type is broadcast if its size checks out; any other parent is joined on
    the reference, where the adaptive plan broadcasts small ones and splits hot keys.
    """
    p = parent.select(F.col(parent_key).alias("_ref"), *[F.col(c).alias(a) for a, c in fields.items()])
    if global_parent:
        p = small_side(p)
    return child.join(p, child[reference] == p["_ref"], "left").drop("_ref")
