"""Group outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import as_col


def count() -> Column:
    return F.count(F.lit(1))


def total(e) -> Column:
    return F.sum(as_col(e))


def mean(e) -> Column:
    return F.avg(as_col(e))


def least(e) -> Column:
    return F.min(as_col(e))


def greatest(e) -> Column:
    return F.max(as_col(e))


def stddev(e, sample: bool = False) -> Column:
    return F.stddev_samp(as_col(e)) if sample else F.stddev_pop(as_col(e))


def xor(e) -> Column:
    return F.bit_xor(as_col(e).cast("bigint"))


def _checked(quantiles: Sequence[float]) -> list[float]:
    qs = [float(q) for q in quantiles]
    if not qs or any(not 0 <= q <= 1 for q in qs):
        raise ValueError("quantiles need at least one value, each between 0 and 1")
    return qs


def quantiles(qs: Sequence[float], e) -> Column:
    """Exact, linearly interpolated.

    The aggregate keeps counts per distinct value, so its state grows with the distinct
    values of one group; :func:`quantiles_approx` keeps a bounded sketch instead, and
    ``operators.grouping.group_quantiles`` is exact without any per-group state.
    """
    return F.percentile(as_col(e), F.array(*[F.lit(q) for q in _checked(qs)]))


def quantiles_approx(qs: Sequence[float], e, accuracy: int = 10_000) -> Column:
    return F.percentile_approx(as_col(e), F.array(*[F.lit(q) for q in _checked(qs)]), F.lit(accuracy))


# A KLL sketch of size k names a value whose rank is off by at most 2.296 / k^0.9021 of the rows, 99 times in 100.
KLL_FACTOR, KLL_POWER = 2.296, 0.9021
KLL_SIZE = 200


def quantile_error(size: int = KLL_SIZE) -> float:
    """Rank error of a quantile state, as a share of its rows, at 99 % confidence; merging keeps it."""
    return KLL_FACTOR / size**KLL_POWER


def quantile_state(e, size: int = KLL_SIZE) -> Column:
    """A sketch of a few kilobytes for any number of rows, which :func:`merged_quantile_state` can add up.

    Nulls and NaN are not counted; up to about ``size`` values it is exact.  ``size`` is 8 to 65,535.
    """
    v = as_col(e).cast("double")
    return F.kll_sketch_agg_double(F.nanvl(v, F.lit(None).cast("double")), F.lit(size))


def merged_quantile_state(state="state") -> Column:
    """The state of all rows behind a group's states."""
    return F.kll_merge_agg_double(as_col(state))


def state_count(state="state") -> Column:
    """Rows that a state has seen."""
    return F.kll_sketch_get_n_double(as_col(state))


def state_quantiles(qs: Sequence[float], state="state") -> Column:
    """Array of the quantiles of a state, each a value that occurs; null where it has seen no row."""
    s = as_col(state)
    found = F.kll_sketch_get_quantile_double(s, F.array(*[F.lit(q) for q in _checked(qs)]))
    return F.when(F.kll_sketch_get_n_double(s) > 0, found)


def relevance(score="relevance") -> Column:
    """Average relevance of the group's hits."""
    return F.avg(as_col(score))
