"""Column helpers with the null rules of the panel features."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import NEAR_ZERO


def zero_sum(*columns: Column) -> Column:
    """Sum in which a NULL term counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns])


def tolerant_sum(present: Iterable[str], members: Iterable[str]) -> Column:
    """Sum of those members that exist, NULL as zero; the integer 0 when none exists."""
    present = set(present)
    found = [F.col(m) for m in members if m in present]
    return zero_sum(*found) if found else F.lit(0)


def ratio(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """numerator / denominator where the denominator is positive, else ``otherwise``."""
    value = F.when(denominator > 0, numerator.cast("double") / denominator)
    return value if otherwise is None else value.otherwise(F.lit(otherwise))


def relative_change(value: Column, before: Column) -> Column:
    """(value - before) / |before|, NULL when ``before`` is NULL or practically zero."""
    return F.when(F.abs(before) > NEAR_ZERO, (value - before) / F.abs(before).cast("double"))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def clip(value: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def logistic(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))
