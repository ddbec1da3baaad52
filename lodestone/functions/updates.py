"""Field update operations: each is a function from the stored column to the new one.

Operands may be literals or columns of the change row, so one job applies a different
value to every document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FieldOp = Callable[[Column], Column]


def _v(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def assign(value) -> FieldOp:
    return lambda c: _v(value)


def clear() -> FieldOp:
    return lambda c: F.lit(None)


def increment(delta=1) -> FieldOp:
    return lambda c: c + _v(delta)


def decrement(delta=1) -> FieldOp:
    return lambda c: c - _v(delta)


def multiply(factor) -> FieldOp:
    return lambda c: c * _v(factor)


def divide(divisor) -> FieldOp:
    return lambda c: F.try_divide(c, _v(divisor))


def add_elements(elements) -> FieldOp:
    """Append to an array; repeated values stay."""
    return lambda c: F.concat(F.coalesce(c, F.array()), _v(elements))


def add_weights(weights: Column) -> FieldOp:
    """Put keys into a weighted set; a key already there takes the new weight."""

    def op(c: Column) -> Column:
        kept = F.map_filter(c, lambda k, _: ~F.array_contains(F.map_keys(weights), k))
        return F.when(c.isNull(), weights).otherwise(F.map_concat(kept, weights))

    return op


def remove_elements(elements) -> FieldOp:
    """Drop every occurrence of the given values from an array."""
    return lambda c: F.filter(c, lambda x: ~F.array_contains(_v(elements), x))


def remove_keys(keys) -> FieldOp:
    return lambda c: F.map_filter(c, lambda k, _: ~F.array_contains(_v(keys), k))


def match_key(key, inner: FieldOp) -> FieldOp:
    """Apply an operation to one key of a map; other keys stay."""
    return lambda c: F.transform_values(c, lambda k, v: F.when(k == _v(key), inner(v)).otherwise(v))


def match_index(index, inner: FieldOp) -> FieldOp:
    """Apply an operation to one array position (from 0)."""
    return lambda c: F.transform(c, lambda x, i: F.when(i == _v(index), inner(x)).otherwise(x))


def modify_cells(how: str, cells: Column) -> FieldOp:
    """``replace``, ``add`` or ``multiply`` the cells named in a map; absent cells are ignored."""
    ops = {"replace": lambda v, n: n, "add": lambda v, n: v + n, "multiply": lambda v, n: v * n}
    fn = ops[how]

    def value(v: Column, n: Column) -> Column:
        return F.when(n.isNotNull(), fn(v, n)).otherwise(v)

    return lambda c: F.transform_values(c, lambda k, v: value(v, F.try_element_at(cells, k)))


def modify_dense(how: str, cells: Column) -> FieldOp:
    """The same for a dense tensor; ``cells`` is a map from index to value."""
    ops = {"replace": lambda v, n: n, "add": lambda v, n: v + n, "multiply": lambda v, n: v * n}
    fn = ops[how]

    def cell(v: Column, i: Column) -> Column:
        n = F.try_element_at(cells, i).cast("double")
        return F.when(n.isNotNull(), fn(v.cast("double"), n)).otherwise(v.cast("double"))

    return lambda c: F.transform(c, cell)


def struct_member(path: str, inner: FieldOp) -> FieldOp:
    """Apply an operation to a member (dotted path) of a struct."""

    def op(c: Column) -> Column:
        cur = c
        for p in path.split("."):
            cur = cur.getField(p)
        return c.withField(path, inner(cur))

    return op


def at_path(*steps, op: FieldOp) -> FieldOp:
    """Combine path steps: a name is a struct member, ``{'key': k}`` a map key, an int a position."""
    for s in reversed(steps):
        if isinstance(s, dict):
            op = match_key(s["key"], op)
        elif isinstance(s, int):
            op = match_index(s, op)
        else:
            op = struct_member(s, op)
    return op


def in_order(*ops: FieldOp) -> FieldOp:
    """Several operations on one field, left to right."""

    def op(c: Column) -> Column:
        for o in ops:
            c = o(c)
        return c

    return op
