"""Period arithmetic on integer columns (YYYYMM months or plain indexes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH = "month"
INDEX = "index"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_number(period: str | Column) -> Column:
    """Months since year 0 of a YYYYMM integer."""
    p = _col(period).cast("bigint")
    return F.floor(p / 100) * 12 + p % 100 - 1


def yyyymm_add(period: str | Column, k: int) -> Column:
    """YYYYMM plus ``k`` months (``k`` may be negative), rolling over years."""
    n = month_number(period) + F.lit(k)
    return F.floor(n / 12) * 100 + F.pmod(n, F.lit(12)) + 1


def period_position(period: str | Column, granularity: str = MONTH) -> Column:
    """A number that grows by one per period, so that consecutive periods differ by 1."""
    if granularity == MONTH:
        return month_number(period)
    if granularity == INDEX:
        return _col(period).cast("bigint")
    raise ValueError(f"unknown granularity {granularity!r}")


def period_add(period: str | Column, k: int, granularity: str = MONTH) -> Column:
    if granularity == MONTH:
        return yyyymm_add(period, k)
    return period_position(period, granularity) + F.lit(k)


def period_date(period: str | Column) -> Column:
    """First day of a YYYYMM month."""
    p = _col(period).cast("int")
    return F.make_date(F.floor(p / 100).cast("int"), p % 100, F.lit(1))
