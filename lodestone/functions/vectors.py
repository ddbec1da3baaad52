"""Vector distances as column expressions, and tensor column reshaping."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.predicates import haversine_km
from lodestone.functions.text import as_col

# Up to this length a literal query vector is unrolled into plain arithmetic, which is
# compiled; longer ones use the higher-order functions.
UNROLL = 128


def _fold(terms: list[Column]) -> Column:
    """A balanced sum keeps the expression tree shallow."""
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def literal_vector(v: Sequence[float]) -> Column:
    """A constant tensor as an array literal."""
    return F.array(*[F.lit(float(x)) for x in v])


def _pairwise(a: Column, b, unrolled, paired) -> Column:
    if not isinstance(b, Column):
        if len(b) <= UNROLL:
            cells = [unrolled(F.get(a, F.lit(i)).cast("double"), float(x)) for i, x in enumerate(b)]
            return F.when(F.size(a) == len(b), _fold(cells))
        b = literal_vector(b)
    pairs = F.zip_with(a, b, lambda x, y: paired(x.cast("double"), y.cast("double")))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b) -> Column:
    """Inner product; higher is better."""
    return _pairwise(as_col(a), b, lambda x, c: x * F.lit(c), lambda x, y: x * y)


def squared_euclidean(a: Column | str, b) -> Column:
    return _pairwise(
        as_col(a), b, lambda x, c: (x - F.lit(c)) * (x - F.lit(c)), lambda x, y: (x - y) * (x - y)
    )


def euclidean(a: Column | str, b) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def angular(a: Column | str, b) -> Column:
    """1 - cosine."""
    nb = norm(b) if isinstance(b, Column) else F.lit(math.sqrt(sum(float(x) ** 2 for x in b)))
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * nb)


def prenormalized_angular(a: Column | str, b) -> Column:
    """1 - dot, for unit vectors."""
    return F.lit(1.0) - dot(a, b)


def sign_bits(a: Column | str, dims: int) -> Column:
    """Signs packed into ``ceil(dims/64)`` longs, cell ``i`` in bit ``i % 64``."""
    a = as_col(a)
    longs = []
    for lo in range(0, dims, 64):
        bits = [
            F.when(F.get(a, F.lit(i)) > 0, F.shiftleft(F.lit(1).cast("bigint"), i - lo)).otherwise(F.lit(0).cast("bigint"))
            for i in range(lo, min(lo + 64, dims))
        ]
        longs.append(reduce(lambda x, y: x.bitwiseOR(y), bits))
    return F.array(*longs)


def pack_signs(v: Sequence[float]) -> list[int]:
    """The same packing for one query vector."""
    out = []
    for lo in range(0, len(v), 64):
        n = sum(1 << i for i, x in enumerate(v[lo : lo + 64]) if x > 0)
        out.append(n - (1 << 64) if n >= 1 << 63 else n)
    return out


def hamming(a: Column, b) -> Column:
    """Differing bits of two packed sign arrays (``b`` an array column or packed query longs)."""
    if not isinstance(b, Column):
        return _fold([F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.lit(x).cast("bigint"))) for i, x in enumerate(b)])
    diff = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(diff, F.lit(0), lambda acc, x: acc + x)


def geodesic(lat: Column | str, lng: Column | str, lat2, lng2) -> Column:
    return haversine_km(lat, lng, lat2, lng2)


METRICS = {
    "euclidean": euclidean,
    "angular": angular,
    "prenormalized": prenormalized_angular,
    "dotproduct": dot,
    "hamming": lambda a, b: hamming(as_col(a), b),
    "geodesic": lambda a, b: geodesic(F.get(as_col(a), F.lit(0)), F.get(as_col(a), F.lit(1)), *(b if not isinstance(b, Column) else (b[0], b[1]))),
}


def closeness(distance: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + distance)


# -- shapes ------------------------------------------------------------------------------

_TYPE = re.compile(r"^\s*tensor\s*(?:<\s*(\w+)\s*>)?\s*\(([^)]*)\)\s*$")
_DIM = re.compile(r"^\s*(\w+)\s*(?:\{\s*\}|\[\s*(\d+)\s*\])\s*$")

# Tensor cell types and the Spark cell type each is read as.
CELL_TYPES = {"double": "double", "float": "float", "bfloat16": "float", "int8": "tinyint"}


def tensor_type(text: str) -> tuple[str, dict[str, int | None]]:
    """``tensor<float>(x{},y[2])`` -> (cell type, dimension sizes; ``None`` for a mapped one)."""
    m = _TYPE.match(text)
    if not m or (m[1] or "double") not in CELL_TYPES:
        raise ValueError(f"not a tensor type: {text!r}")
    dims: dict[str, int | None] = {}
    for part in m[2].split(","):
        d = _DIM.match(part)
        if not d or d[1] in dims:
            raise ValueError(f"bad or repeated dimension in {text!r}")
        dims[d[1]] = int(d[2]) if d[2] else None
    return m[1] or "double", dims


def tensor_type_text(cell: str, dims: dict[str, int | None]) -> str:
    inner = ",".join(f"{d}{{}}" if n is None else f"{d}[{n}]" for d, n in dims.items())
    return f"tensor({inner})" if cell == "double" else f"tensor<{cell}>({inner})"


def shape_ok(c: Column | str, type_text: str) -> Column:
    """A dense column has the declared size and legal cells (int8: integers in -128..127)."""
    cell, dims = tensor_type(type_text)
    if None in dims.values():
        raise ValueError("shape_ok checks dense tensors")
    c = as_col(c)
    ok = F.size(c) == math.prod(dims.values())
    legal = lambda x: x.isNotNull()
    if cell == "int8":
        legal = lambda x: x.isNotNull() & x.between(-128, 127) & (x == F.floor(x))
    return F.coalesce(ok & F.forall(c, legal), F.lit(False))


def dense_from_cells(cells: Column | str, size: int) -> Column:
    """``map<int,double>`` cells -> dense array, absent cells 0."""
    m = as_col(cells)
    return F.array(*[F.coalesce(F.try_element_at(m, F.lit(i)), F.lit(0.0)) for i in range(size)])


def mapped_from_dense(c: Column | str) -> Column:
    """Dense array -> ``map<string,double>`` keyed by the cell index."""
    c = as_col(c)
    keys = F.transform(F.sequence(F.lit(0), F.size(c) - 1), lambda i: i.cast("string"))
    return F.when(F.size(c) > 0, F.map_from_arrays(keys, c.cast("array<double>"))).otherwise(
        F.create_map().cast("map<string,double>")
    )


def blocks_from_dense(c: Column | str, width: int) -> Column:
    """Dense array -> ``map<string,array<double>>`` of rows of ``width`` cells."""
    c = as_col(c).cast("array<double>")
    n = F.ceil(F.size(c) / F.lit(width)).cast("int")
    starts = F.sequence(F.lit(0), n - 1)
    return F.map_from_arrays(
        F.transform(starts, lambda i: i.cast("string")),
        F.transform(starts, lambda i: F.slice(c, i * width + 1, F.lit(width))),
    )


def dense_from_blocks(blocks: Column | str) -> Column:
    """Inverse of :func:`blocks_from_dense`: rows joined in index order."""
    m = as_col(blocks)
    keys = F.array_sort(F.transform(F.map_keys(m), lambda k: k.cast("int")))
    return F.flatten(F.transform(keys, lambda k: F.element_at(m, k.cast("string"))))


def tensor_cells(json: Column | str) -> Column:
    """Tensor JSON in any of the five layouts -> ``array<struct<address,values>>``.

    dense ``[1,2]`` / nested arrays / ``{"values":[..]}`` give one cell block with an empty
    address; ``{"a":1}`` and ``{"cells":{..}}`` one block per label; ``{"x1":[..]}`` and
    ``{"blocks":{..}}`` one per label with several values; the list forms
    ``{"blocks":[{address,values}]}`` and ``[{address,value}]`` keep their full address.
    """
    j = F.trim(as_col(json))
    # an object may wrap its payload in one of three reserved keys
    wrapped = F.coalesce(
        F.get_json_object(j, "$.values"), F.get_json_object(j, "$.cells"), F.get_json_object(j, "$.blocks"), j
    )
    out = "array<struct<address:map<string,string>,values:array<double>>>"
    is_array = wrapped.startswith("[")
    has_address = wrapped.rlike(r'^\[\s*\{')
    listed = F.transform(
        F.from_json(wrapped, "array<struct<address:map<string,string>,value:double,values:array<double>>>"),
        lambda e: F.struct(
            e["address"].alias("address"), F.coalesce(e["values"], F.array(e["value"])).alias("values")
        ),
    )
    # nested arrays flatten row-major: dropping the inner brackets keeps the order
    flat = F.from_json(
        F.concat(F.lit("["), F.regexp_replace(wrapped, r"[\[\]]", ""), F.lit("]")), "array<double>"
    )
    no_address = F.create_map().cast("map<string,string>")
    dense = F.array(F.struct(no_address.alias("address"), flat.alias("values")))
    label = lambda k: F.create_map(F.lit("x"), k)
    per_label = lambda m, vals: F.transform(
        F.map_entries(m), lambda e: F.struct(label(e["key"]).alias("address"), vals(e["value"]).alias("values"))
    )
    blocks = per_label(F.from_json(wrapped, "map<string,array<double>>"), lambda v: v)
    cells = per_label(F.from_json(wrapped, "map<string,double>"), lambda v: F.array(v))
    return (
        F.when(is_array & has_address, listed.cast(out))
        .when(is_array, dense.cast(out))
        .when(wrapped.rlike(r'^\{\s*"[^"]*"\s*:\s*\['), blocks.cast(out))
        .otherwise(cells.cast(out))
    )


def tensor_dense(json: Column | str, cell: str = "float") -> Column:
    """Dense tensor JSON (plain, nested or wrapped) -> array of the cell type."""
    c = tensor_cells(json)
    return F.get(c, F.lit(0))["values"].cast(f"array<{CELL_TYPES[cell]}>")


# Fixed values of the sample feature vector: clip limit, log scale, bucket limits and levels.
AMOUNT_CLIP, AMOUNT_LOG = 500.0, 3.0
AMOUNT_STEPS = [(50.0, 0.2), (150.0, 0.5), (None, 0.8)]


def amount_category_vector(amount: Column | str, category: Column | str, categories: Sequence[str]) -> Column:
    """One-hot category cells, then the amount clipped to [0, 1], in log10 and as a bucket level."""
    amount, category = as_col(amount).cast("double"), as_col(category)
    level = None
    for limit, value in AMOUNT_STEPS[:-1]:
        level = F.when(amount < limit, value) if level is None else level.when(amount < limit, value)
    return F.array(
        *[F.when(category == c, 1.0).otherwise(0.0) for c in categories],
        F.greatest(F.least(amount / AMOUNT_CLIP, F.lit(1.0)), F.lit(0.0)),
        F.log10(amount + 1) / AMOUNT_LOG,
        level.otherwise(AMOUNT_STEPS[-1][1]),
    )
