"""Comparison, set, boolean, element, rule and geographic predicates."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import as_col

EARTH_KM = 6371.0
KM_PER_DEGREE = math.pi * EARTH_KM / 180.0


def compare(c: Column | str, op: str, value) -> Column:
    """``> < >= <= =``; equality takes numbers and booleans, text has its own operators."""
    c = as_col(c)
    if op == "=":
        if isinstance(value, str):
            raise TypeError("'=' compares numbers and booleans; use a text predicate for strings")
        return c == F.lit(value)
    ops = {">": c.__gt__, "<": c.__lt__, ">=": c.__ge__, "<=": c.__le__}
    return ops[op](F.lit(value))


def is_in(c: Column | str, values: Iterable) -> Column:
    values = list(values)
    return as_col(c).isin(values) if values else F.lit(False)


def in_range(c: Column | str, lo=None, hi=None, bounds: str | None = None) -> Column:
    """Inclusive by default; ``open``, ``leftOpen`` and ``rightOpen`` exclude ends."""
    if bounds not in (None, "open", "leftOpen", "rightOpen"):
        raise ValueError(f"unknown bounds {bounds!r}")
    c = as_col(c)
    out = F.lit(True)
    if lo is not None:
        out = c > F.lit(lo) if bounds in ("open", "leftOpen") else c >= F.lit(lo)
    if hi is not None:
        out = out & (c < F.lit(hi) if bounds in ("open", "rightOpen") else c <= F.lit(hi))
    return out


def all_of(*preds: Column) -> Column:
    """Conjunction; no operand means everything matches."""
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def any_of(*preds: Column) -> Column:
    """Flat disjunction; one operand stands for itself."""
    if not preds:
        raise ValueError("any_of needs at least one operand")
    return reduce(lambda a, b: a | b, preds)


def true() -> Column:
    return F.lit(True)


def false() -> Column:
    return F.lit(False)


def same_element(array: Column | str, condition) -> Column:
    """One element of the array satisfies the whole condition."""
    return F.exists(as_col(array), condition)


# -- rules carried by the document ------------------------------------------------------

RULE_TYPE = "array<struct<attr:string,negate:boolean,values:array<string>,lo:bigint,hi:bigint>>"


def rule_values(attr: str, values: Column, negate: bool = False) -> Column:
    """``attr in values`` (optionally negated) as one element of a rule column."""
    none = F.lit(None).cast("bigint")
    return F.struct(
        F.lit(attr).alias("attr"), F.lit(negate).alias("negate"), values.cast("array<string>").alias("values"),
        none.alias("lo"), none.alias("hi"),
    )


def rule_range(attr: str, lo: Column, hi: Column) -> Column:
    """``lo <= attr <= hi`` as one element of a rule column."""
    return F.struct(
        F.lit(attr).alias("attr"), F.lit(False).alias("negate"), F.lit(None).cast("array<string>").alias("values"),
        lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"),
    )


def rule_holds(rules: Column | str, attrs: Column, ranges: Column) -> Column:
    """Whether a conjunction of rule elements accepts the given attribute maps.

    ``attrs`` is ``map<string,string>``, ``ranges`` is ``map<string,bigint>``.  A missing
    attribute fails a positive condition and passes a negated one.
    """

    def holds(r: Column) -> Column:
        v = F.try_element_at(attrs, r["attr"])
        n = F.try_element_at(ranges, r["attr"])
        listed = F.coalesce(F.array_contains(r["values"], v), F.lit(False))
        return F.when(r["values"].isNotNull(), listed != r["negate"]).otherwise(
            F.coalesce(n.between(r["lo"], r["hi"]), F.lit(False))
        )

    return F.forall(as_col(rules), holds)


def literal_map(values: Mapping, key: str = "string", value: str = "bigint") -> Column:
    """A small map literal built from query arguments."""
    if not values:
        return F.create_map().cast(f"map<{key},{value}>")
    flat = [F.lit(x) for kv in values.items() for x in kv]
    return F.create_map(*flat).cast(f"map<{key},{value}>")


def predicate_matches(rules: Column | str, attributes: Mapping[str, str], ranges: Mapping[str, int] | None = None) -> Column:
    """The rule column accepts one query's attribute values."""
    return rule_holds(rules, literal_map(attributes, value="string"), literal_map(ranges or {}))


# -- geography --------------------------------------------------------------------------


def haversine_km(lat: Column | str, lng: Column | str, lat2, lng2) -> Column:
    lat, lng = F.radians(as_col(lat)), F.radians(as_col(lng))
    to_rad = lambda v: F.radians(v) if isinstance(v, Column) else F.lit(math.radians(v))
    lat2, lng2 = to_rad(lat2), to_rad(lng2)
    a = F.pow(F.sin((lat2 - lat) / 2), 2) + F.cos(lat) * F.cos(lat2) * F.pow(F.sin((lng2 - lng) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within_box(lat: Column | str, lng: Column | str, south: float, west: float, north: float, east: float) -> Column:
    """Bounding box; ``west > east`` wraps the date line."""
    lat, lng = as_col(lat), as_col(lng)
    span = lng.between(west, east) if west <= east else (lng >= west) | (lng <= east)
    return lat.between(south, north) & span


def within_radius(lat: Column | str, lng: Column | str, lat0: float, lng0: float, km: float) -> Column:
    """Great-circle radius: a latitude/longitude box, which the scan can use, then the distance."""
    d = km / KM_PER_DEGREE * (1 + 1e-9) + 1e-9
    south, north = lat0 - d, lat0 + d
    near = haversine_km(lat, lng, lat0, lng0) <= km
    if south <= -90 or north >= 90:
        return as_col(lat).between(south, north) & near
    # widest longitude span of the circle, reached north or south of the centre
    half = math.degrees(math.asin(min(1.0, math.sin(math.radians(d)) / math.cos(math.radians(lat0))))) + 1e-9
    wrap = lambda x: (x + 180.0) % 360.0 - 180.0
    if half >= 180:
        return as_col(lat).between(south, north) & near
    west, east = lng0 - half, lng0 + half
    if west < -180 or east > 180:
        west, east = wrap(west), wrap(east)
    return within_box(lat, lng, south, west, north, east) & near
