"""Choosing columns and periods."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def require_unique_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Fail when a key occurs twice (one pass, combined map-side)."""
    if not df.groupBy(*key).count().filter("count > 1").isEmpty():
        raise ValueError(f"duplicate rows for the key {list(key)}")
    return df


def drop_if_exists(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def model_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric and boolean columns; an error when none is left."""
    exclude = set(exclude)
    kept = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in exclude
    ]
    if not kept:
        raise ValueError("no numeric columns left")
    return kept


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*model_columns(df, exclude))


def align_features(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), strict: bool = False
) -> DataFrame:
    """The trained features in their order; absent ones become 0.0, or an error if strict."""
    absent = [f for f in features if f not in df.columns]
    if absent and strict:
        raise KeyError(f"trained columns are missing: {absent}")
    return df.select(
        *keep, *[F.lit(0.0).alias(f) if f in absent else F.col(f) for f in features]
    )


def distinct_periods(df: DataFrame, period: str) -> list[int]:
    """Sorted periods: one row per period reaches the driver."""
    return [r[0] for r in df.select(period).distinct().orderBy(period).collect()]


def filter_periods(df: DataFrame, period: str, periods: Sequence[int]) -> DataFrame:
    """Rows of the given periods; a literal list, so that it prunes partitions and files."""
    return df.filter(F.col(period).isin(list(periods)))


def filter_period(df: DataFrame, period: str, value: int, must_exist: bool = True) -> DataFrame:
    """Rows of one period; an error when there are none.

    The check looks for a first row, which runs what ``df`` is made of: for a table or staged
    frame that is cheap, others pass ``must_exist=False`` and check what they stage.
    """
    chosen = df.filter(F.col(period) == value)
    if must_exist and chosen.isEmpty():
        raise ValueError(f"no rows for period {value}")
    return chosen


def filter_class(
    df: DataFrame, target: str, value: str, equal: bool = True, keep_null: bool = False
) -> DataFrame:
    """Rows with or without a class; ``keep_null`` keeps rows without a target on "not equal"."""
    column = F.col(target)
    if equal:
        return df.filter(column == value)
    return df.filter(~column.eqNullSafe(value) if keep_null else column != value)


@dataclass(frozen=True)
class Periods:
    train: list[int]
    future: list[int]
    overlap: list[int]


def resolve_periods(
    available: Sequence[int],
    train: Sequence[int] | None = None,
    future: Sequence[int] | None = None,
    default_future: Sequence[int] = (),
) -> Periods:
    """Training and future periods: given lists, else defaults; train defaults to the rest."""
    chosen_future = list(future) if future else list(default_future)
    chosen_train = list(train) if train else [p for p in available if p not in set(chosen_future)]
    overlap = sorted(set(chosen_train) & set(chosen_future))
    if overlap:
        logger.warning("periods used for training and as future: %s", overlap)
    return Periods(chosen_train, chosen_future, overlap)


def train_future_split(
    df: DataFrame, period: str, periods: Periods
) -> tuple[DataFrame, DataFrame]:
    return (
        filter_periods(df, period, periods.train),
        filter_periods(df, period, periods.future),
    )


def keys_in_both(df: DataFrame, key: str, period: str, first: int, second: int) -> DataFrame:
    """Entities with a row in both periods (``INTERSECT``)."""
    of = lambda p: df.filter(F.col(period) == p).select(key)
    return of(first).intersect(of(second))


def keys_only_in(df: DataFrame, key: str, period: str, first: int, second: int) -> DataFrame:
    """Entities of the first period that have no row in the second (``EXCEPT``)."""
    of = lambda p: df.filter(F.col(period) == p).select(key)
    return of(first).subtract(of(second))
