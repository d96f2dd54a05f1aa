"""Drift (population stability index) and outlier reports per period."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from .quantiles import MARGIN, doubles, exact_percentiles, long_values, per_column
from .selection import distinct_periods

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: counters of periods that a task holds at a time
HELD_BYTES = 64_000_000


def baseline_periods(
    df: DataFrame, period: str, count: int = fixed.BASELINE_PERIODS
) -> list[int]:
    """The last ``count`` distinct periods, ascending."""
    return distinct_periods(df, period)[-count:]


def psi_cuts(
    df: DataFrame,
    columns: Sequence[str],
    buckets: int = fixed.PSI_BUCKETS,
    margin: float = MARGIN,
) -> dict[str, list[float]]:
    """Distinct quantile cuts of each column; fewer than two for constant or empty ones."""
    grid = [i * (1.0 / buckets) for i in range(buckets)] + [1.0]
    quantiles = exact_percentiles(df, columns, grid, margin)
    return {c: sorted(set(q)) if q else [] for c, q in quantiles.items()}


def _binned(name: str, cuts: Sequence[Sequence[float]]):
    """Values by period, column and bin, one row each and task.

    1, 2, … are half-open bins between the cuts, the last one closed; 0 is a value outside
    the cuts (or any value, when there are fewer than two cuts), -1 is NULL or NaN.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = [np.array(c, float) for c in cuts]
        width = max(map(len, edges), default=0) + 2
        total: dict[object, np.ndarray] = {}
        kind = None

        def rows() -> Iterator[pa.RecordBatch]:
            for value, counts in total.items():
                column, at = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value] * len(at), kind), pa.array(column.astype(np.int32)), pa.array((at - 1).astype(np.int32)), pa.array(counts[column, at])],
                    [name, "column", "bin", "n"])
            total.clear()

        for batch in batches:
            periods = batch.column(0).dictionary_encode()
            kind, values = periods.dictionary.type, [*periods.dictionary.to_pylist(), None]
            code = periods.indices.fill_null(len(values) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.zeros((len(values), len(edges), width), np.int64)
            for i, e in enumerate(edges):
                x, n = doubles(batch, i + 1), len(e)
                missing = np.isnan(x)
                if n < 2:
                    bins = np.zeros(len(x), np.int64)
                else:
                    bins = np.searchsorted(e, x, "right")
                    bins = np.where(bins < n, bins, np.where(x == e[-1], n - 1, 0))
                cell = code * width + np.where(missing, -1, bins) + 1
                counts[:, i] = np.bincount(cell, minlength=len(values) * width).reshape(len(values), width)
            for value, found in zip(values, counts):
                if value in total:
                    total[value] += found
                else:
                    total[value] = found.copy()
            if len(total) * counts[0].nbytes > HELD_BYTES:
                yield from rows()
        yield from rows()
    return run


def psi_by_column_period(
    df: DataFrame,
    period: str,
    columns: Sequence[str],
    baseline: Sequence[int] | None = None,
    buckets: int = fixed.PSI_BUCKETS,
    epsilon: float = fixed.PSI_EPSILON,
    margin: float = MARGIN,
) -> DataFrame:
    """PSI of every column and period against the baseline periods.

    One counting pass over the columns side by side: every value finds its bin among its column's cuts by
    binary search, tasks count (period, column, bin), and a shuffle adds up the tasks; the rest works on
    one array of counters a period and column.  Cuts are rows, not text of the plan.  PSI is 0 for
    a column with fewer than two cuts, NULL when a side has no value or when no value of the
    period lies within the baseline's range.
    """
    columns = list(columns)
    baseline = baseline_periods(df, period) if baseline is None else list(baseline)
    in_baseline = F.col(period).isin(baseline)
    cuts = psi_cuts(df.filter(in_baseline), columns, buckets, margin)

    spark = df.sparkSession
    table = per_column(
        spark, [(i, c, [float(x) for x in cuts[c]]) for i, c in enumerate(columns)], "name string, cuts array<double>"
    )
    doubled = df.select(F.col(period), *[F.col(f"`{c}`").cast("double") for c in columns])
    kind = df.schema[period].dataType.simpleString()
    binned = doubled.mapInArrow(_binned(period, [[float(x) for x in cuts[c]] for c in columns]), f"`{period}` {kind}, column int, bin int, n bigint")
    counts = binned.groupBy(period, "column", "bin").agg(F.sum("n").alias("n"))
    # a counter of every bin, -1 and 0 first; one short array a period and column
    entries = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    by_bin = counts.groupBy(period, "column").agg(entries.alias("_m")).join(table, "column")
    counters = by_bin.select(
        period, "column", F.col("name"), (F.size("cuts") - 1).alias("bins"),
        F.transform(
            F.sequence(F.lit(-1), F.greatest(F.size("cuts") - 1, F.lit(0))),
            lambda b: F.coalesce(F.element_at("_m", b), F.lit(0)),
        ).alias("actual"),
    )
    base = counters.filter(in_baseline).select("column", F.posexplode("actual").alias("at", "n"))
    expected = base.groupBy("column", "at").agg(F.sum("n").alias("n")).groupBy("column").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "n"))), lambda x: x["n"]).alias("expected")
    )
    both = counters.join(expected, "column", "left").select(
        period, "name", "bins",
        F.aggregate(F.slice("actual", F.lit(2), F.size("actual") - 1), F.lit(0).cast("long"), lambda a, n: a + n).alias("valid"),
        F.slice("actual", F.lit(3), F.greatest("bins", F.lit(0))).alias("a"),
        F.slice("expected", F.lit(3), F.greatest("bins", F.lit(0))).alias("e"),
    )
    total = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, n: a + n)
    both = both.select("*", total("a").alias("in_a"), total("e").alias("in_e"))

    def share(n: Column, of: str) -> Column:
        return F.greatest(F.least(n / F.col(of), F.lit(1.0)), F.lit(float(epsilon)))

    terms = F.zip_with(
        "e", "a", lambda e, a: (share(e, "in_e") - share(a, "in_a")) * F.ln(share(e, "in_e") / share(a, "in_a"))
    )
    value = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    psi = (
        F.when((F.col("valid") == 0) | (F.col("bins") < 0), F.lit(None).cast("double"))
        .when(F.col("bins") == 0, F.lit(0.0))
        .when((F.col("in_a") > 0) & (F.col("in_e") > 0), value)
    )
    return both.select(period, F.col("name").alias("column"), psi.alias("psi"))


def _by_period(
    rates: DataFrame, period: str, value: str, low: float, high: float, n_columns: int,
    low_name: str, high_name: str, flag_name: str, flag_average_over: float,
) -> DataFrame:
    v = F.col(value)
    summary = rates.groupBy(period).agg(
        F.avg(v).alias(f"avg_{value}"),
        F.max(v).alias(f"max_{value}"),
        F.count_if(F.coalesce(v > low, F.lit(False))).alias(low_name),
        F.count_if(F.coalesce(v > high, F.lit(False))).alias(high_name),
    )
    flagged = F.coalesce(F.col(f"avg_{value}") > flag_average_over, F.lit(False)) | (
        F.col(high_name) > n_columns * fixed.FLAGGED_COLUMN_SHARE
    )
    return summary.select("*", flagged.alias(flag_name))


def drift_by_period(psi: DataFrame, period: str, n_columns: int) -> DataFrame:
    """Average and maximum PSI, columns above both limits, and the drift flag."""
    low, high = fixed.PSI_LIMITS
    return _by_period(
        psi, period, "psi", low, high, n_columns, "columns_over_low", "columns_over_high",
        "drift_flag", low,
    )


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], factor: float = fixed.IQR_FACTOR, margin: float = MARGIN
) -> dict[str, tuple[float, float] | None]:
    """Q1 - factor * IQR and Q3 + factor * IQR over all periods."""
    quartiles = exact_percentiles(df, columns, [0.25, 0.75], margin)
    return {
        c: (q[0] - factor * (q[1] - q[0]), q[1] + factor * (q[1] - q[0])) if q else None
        for c, q in quartiles.items()
    }


def outlier_rate_by_column_period(
    df: DataFrame, period: str, columns: Sequence[str], margin: float = MARGIN
) -> DataFrame:
    """Share of the rows of a period outside the bounds, per column.

    NULL and NaN are not outliers but count as rows; a period without any value of a column
    has no rate.  One counting pass over the values listed by column; bounds are rows, not text of the plan.
    """
    columns = list(columns)
    bounds = iqr_bounds(df, columns, margin=margin)

    table = per_column(
        df.sparkSession, [(i, c, *(bounds[c] or (None, None))) for i, c in enumerate(columns)],
        "name string, low double, high double",
    )
    known = F.col("value").isNotNull() & ~F.isnan("value")
    hit = known & ((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
    counted = (
        long_values(df, columns, period)
        .join(table, "column")
        .groupBy(period, "name")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(known).alias("known"), F.count_if(hit).alias("hits"))
    )
    rate = F.when(F.col("known") > 0, F.col("hits") / F.col("rows"))
    return counted.select(period, F.col("name").alias("column"), rate.alias("outlier_rate"))


def outlier_by_period(rates: DataFrame, period: str, n_columns: int) -> DataFrame:
    """Average and maximum outlier rate, columns above both limits, and the outlier flag."""
    low, high = fixed.OUTLIER_LIMITS
    return _by_period(
        rates, period, "outlier_rate", low, high, n_columns, "columns_over_low",
        "columns_over_high", "outlier_flag", low,
    )


def periods_to_drop(drift: DataFrame, outliers: DataFrame, period: str) -> DataFrame:
    """Periods flagged by either report."""
    return (
        drift.filter("drift_flag")
        .select(period)
        .union(outliers.filter("outlier_flag").select(period))
        .distinct()
    )


def without_periods(df: DataFrame, bad: DataFrame, period: str) -> DataFrame:
    """The panel without the given periods (anti join; the list has one row per period)."""
    return df.join(bad.select(period), period, "left_anti")
