"""Scalar functions usable in group keys, group order and outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.ids import user_part
from lodestone.functions.text import as_col


def time_date(ts) -> Column:
    """yyyymmdd as an integer."""
    ts = as_col(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_year(ts) -> Column:
    return F.year(as_col(ts))


def time_month_of_year(ts) -> Column:
    return F.month(as_col(ts))


def time_day_of_month(ts) -> Column:
    return F.dayofmonth(as_col(ts))


def time_hour_of_day(ts) -> Column:
    return F.hour(as_col(ts))


def time_minute_of_hour(ts) -> Column:
    return F.minute(as_col(ts))


def time_second_of_minute(ts) -> Column:
    return F.second(as_col(ts))


def math_floor(e) -> Column:
    return F.floor(as_col(e))


def math_log(e) -> Column:
    return F.ln(as_col(e))


def math_sqrt(e) -> Column:
    return F.sqrt(as_col(e))


def math_abs(e) -> Column:
    return F.abs(as_col(e))


def math_pow(e, n: float) -> Column:
    return F.pow(as_col(e), F.lit(float(n)))


def cat(a, b) -> Column:
    return F.concat(as_col(a).cast("string"), as_col(b).cast("string"))


def md5_bits(e, max_length: int, bits: int) -> Column:
    """The lowest ``bits`` (at most 60) of the MD5 of the first ``max_length`` characters."""
    if not 0 < bits <= 60:
        raise ValueError("bits must be between 1 and 60")
    digest = F.md5(F.substring(as_col(e).cast("string"), 1, max_length))
    return F.conv(F.right(digest, F.lit(-(-bits // 4))), 16, 10).cast("bigint").bitwiseAND(
        F.lit((1 << bits) - 1).cast("bigint")
    )


# Collation strengths and Spark's collation suffixes.
STRENGTHS = {"PRIMARY": "_CI_AI", "SECONDARY": "_CI", "TERTIARY": "", None: ""}


def uca(e, locale: str, strength: str | None = None) -> Column:
    """The value under a locale's collation, for ordering, grouping and comparing."""
    name = "UNICODE" if locale in ("", "root") else locale
    return F.collate(as_col(e), name + STRENGTHS[strength.upper() if strength else None])


# Masks that spread or gather the bits of a 31-bit number.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _mask(m: int) -> Column:
    return F.lit(m).cast("bigint")


def _gather(v: Column) -> Column:
    v = v.bitwiseAND(_mask(0x5555555555555555))
    for (shift, _), mask in zip(reversed(_SPREAD), [m for _, m in reversed(_SPREAD)][1:] + [0x00000000FFFFFFFF]):
        v = v.bitwiseOR(F.shiftrightunsigned(v, shift)).bitwiseAND(_mask(mask))
    return v


def _spread(v: Column) -> Column:
    for shift, mask in _SPREAD:
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(_mask(mask))
    return v


def zcurve(x, y) -> Column:
    """Interleave two 31-bit numbers, x in the even bits."""
    return _spread(as_col(x).cast("bigint")).bitwiseOR(F.shiftleft(_spread(as_col(y).cast("bigint")), 1))


def zcurve_x(z) -> Column:
    return _gather(as_col(z))


def zcurve_y(z) -> Column:
    return _gather(F.shiftrightunsigned(as_col(z), 1))


def doc_id_specific(doc_id) -> Column:
    return user_part(doc_id)


def add(a, b) -> Column:
    return as_col(a) + as_col(b)


def mul(a, b) -> Column:
    return as_col(a) * as_col(b)


def div(a, b) -> Column:
    """Null where the divisor is zero."""
    return F.try_divide(as_col(a), as_col(b))


def mod(a, b) -> Column:
    """Null where the divisor is zero."""
    return F.try_mod(as_col(a), as_col(b))


def neg(e) -> Column:
    return -as_col(e)


def cmp(a, b) -> Column:
    a, b = as_col(a), as_col(b)
    return F.when(a < b, -1).when(a > b, 1).when(a == b, 0)


def fixed_width(e, width: float) -> Column:
    """Lower edge of the value's fixed-width bucket."""
    return F.floor(as_col(e) / F.lit(float(width))) * F.lit(float(width))
