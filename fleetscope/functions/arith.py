"""Aggregate arithmetic shared by profiles and shares.

Two modes:

* default: ``sum`` / ``count`` of doubles, what ``avg`` does;
* ``exact_scale=k``: every value is taken as an integer number of ``10^-k`` units
  (``bigint``), summed exactly, and turned into a double once at the end.  Results
  then do not depend on partitioning or summation order, and a partial sum computed
  before a shuffle merges without error.  It is for data with at most ``k`` decimals
  (the spreadsheets hold two): a value with more decimals, NaN, an infinity or a value
  beyond 2^53 units fails the query instead of being rounded.

Sums of already-derived doubles are made order-independent by adding them in
ascending order: a total of daily means by folding a sorted array of at most 31
days, a share denominator by a running sum over the hosts of one client.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# How far a scaled value may lie from a whole unit: what adding doubles of k
# decimals can leave, far below half a unit; and the same relative to large values.
UNIT_ERROR = 1e-6
RELATIVE_ERROR = 2.0 ** -50


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(v, exact_scale: int | None) -> Column:
    """The value to sum: the double itself, or its exact integer units."""
    v = _col(v)
    if exact_scale is None:
        return v
    scaled = v * F.lit(float(10 ** exact_scale))
    whole = F.round(scaled)
    # a double that stands for k decimals is within rounding error of a whole unit
    error = F.greatest(F.lit(UNIT_ERROR), F.abs(scaled) * F.lit(RELATIVE_ERROR))
    fits = (F.abs(scaled) < F.lit(2.0 ** 53)) & (F.abs(scaled - whole) <= error)
    return (F.when(v.isNull(), F.lit(None).cast("bigint"))
            .when(fits, whole.cast("bigint"))
            .otherwise(F.raise_error(F.concat(
                F.lit(f"not representable at exact_scale={exact_scale}: "), v.cast("string"))).cast("bigint")))


def partial_sum(v, exact_scale: int | None) -> Column:
    return F.sum(units(v, exact_scale))


def as_value(s, exact_scale: int | None) -> Column:
    """Turn a (merged) sum back into the metric's unit as a double."""
    s = _col(s)
    if exact_scale is None:
        return s
    return s.cast("double") / F.lit(float(10 ** exact_scale))


def mean(s, n, exact_scale: int | None) -> Column:
    """Mean from a merged sum and count; NULL for a group with no values."""
    return F.try_divide(as_value(s, exact_scale), _col(n).cast("double"))


def ordered_sum(values) -> Column:
    """Sum of an array of doubles in ascending order (NULLs are skipped)."""
    arr = F.array_sort(F.filter(_col(values), lambda x: x.isNotNull()))
    return F.when(F.size(arr) > 0, F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x))


def share(size, total) -> Column:
    return F.try_divide(_col(size), _col(total))


def pct_label(share_col) -> Column:
    """``share`` as a percentage with one decimal, e.g. ``12.3%``.

    Rounds half up on ``1000 * share``; built from integers so every engine
    prints the same text.
    """
    tenths = F.floor(_col(share_col) * F.lit(1000.0) + F.lit(0.5)).cast("bigint")
    mag = F.abs(tenths)
    return F.concat(F.when(tenths < 0, F.lit("-")).otherwise(F.lit("")),
                    (mag / F.lit(10)).cast("bigint").cast("string"), F.lit("."),
                    (mag % F.lit(10)).cast("string"), F.lit("%"))
