"""Group sums, lags and deltas of every numeric column, smoothing and rolling extremes."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..functions.scalars import tolerant_sum
from ..spec import PanelSpec


#: weights inside a segment of a history shrink down to this one
_SMALLEST_WEIGHT = 1e-60


def group_sums(df: DataFrame, groups: dict[str, list[str]] = fixed.BANK_GROUPS) -> DataFrame:
    """Add one horizontal sum per group; absent columns are skipped."""
    present = df.columns
    return df.withColumns({name: tolerant_sum(present, cols) for name, cols in groups.items()})


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns, in order."""
    exclude = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def lag_candidates(
    df: DataFrame, spec: PanelSpec, skip_marks: Sequence[str] = ()
) -> list[str]:
    """Numeric columns besides key and target, without names that carry a given mark."""
    return [
        c
        for c in numeric_columns(df, [*spec.key, spec.target])
        if not any(mark in c for mark in skip_marks)
    ]


def lags_and_deltas(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None, steps: Sequence[int] = (1, 2)
) -> DataFrame:
    """Add ``{c}_lag{k}`` and ``{c}_d{k}`` for every column, in one window projection.

    Written as SQL text: hundreds of columns reach the driver's JVM in one call.
    """
    columns = lag_candidates(df, spec) if columns is None else columns
    history = f"OVER (PARTITION BY `{spec.id}` ORDER BY `{spec.period}`)"
    lagged = df.selectExpr(
        "*", *[f"lag(`{c}`, {k}) {history} AS `{c}_lag{k}`" for c in columns for k in steps]
    )
    return lagged.selectExpr(
        "*", *[f"`{c}` - `{c}_lag{k}` AS `{c}_d{k}`" for c in columns for k in steps]
    )


def alpha_name(alpha: float) -> str:
    return str(alpha).replace(".", "p")


def ema_name(column: str, alpha: float) -> str:
    return f"{column}_ema_alpha{alpha_name(alpha)}"


def _segment_rows(alphas: Sequence[float]) -> int:
    """Rows in which the fastest average's weights shrink to the smallest weight kept."""
    fastest = min([1.0 - a for a in alphas if a < 1.0], default=0.5)
    return max(1, int(math.log(_SMALLEST_WEIGHT) / math.log(fastest)))


def with_ema(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str], alphas: Sequence[float]
) -> DataFrame:
    """Add adjusted exponential moving averages over the history up to each row.

    A history is cut into segments of consecutive rows.  Inside a segment the average is a ratio of
    two running sums of rescaled weights; what the segments before hand over is one numerator and one
    denominator each, so a row looks at the segments before it and not at their rows.  NULL has no
    weight, but the weights before it shrink; before the first value the average is NULL.
    """
    if not columns or not alphas:
        return df
    rows = _segment_rows(alphas)
    at = F.row_number().over(spec.history.rows) - 1
    placed = df.select("*", F.floor(at / rows).alias("_seg"), (at % rows).alias("_at"))
    # the running sums leave rows in the order of the history, which the next window reuses
    inside = Window.partitionBy(spec.id, "_seg").orderBy(spec.period).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(spec.id).orderBy("_seg", spec.period).rowsBetween(Window.unboundedPreceding, -1)
    fading = [a for a in alphas if a < 1.0]
    scale = {a: F.pow(F.lit(1.0 - a), -F.col("_at").cast("double")) for a in fading}
    sums: list[Column] = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        for k, a in enumerate(fading):
            sums += [
                (F.sum(F.coalesce(x, F.lit(0.0)) * scale[a]).over(inside) / scale[a]).alias(f"_n{i}_{k}"),
                (F.sum(F.when(x.isNotNull(), scale[a]).otherwise(0.0)).over(inside) / scale[a]).alias(f"_d{i}_{k}"),
            ]
    summed = placed.select("*", *sums)
    names = [f"_{p}{i}_{k}" for i in range(len(columns)) for k in range(len(fading)) for p in "nd"]
    if names:
        end = F.when(F.col("_at") == rows - 1, F.struct(*names))
        summed = summed.select("*", F.collect_list(end).over(before).alias("_ends"))

    def total(name: str, alpha: float) -> Column:
        shrink = (1.0 - alpha) ** rows
        carried = F.aggregate("_ends", F.lit(0.0), lambda sofar, e: sofar * shrink + e[name])
        late = F.pow(F.lit(1.0 - alpha), F.col("_at").cast("double") + 1.0)
        return F.col(name) + F.when(F.size("_ends") > 0, carried * late).otherwise(0.0)

    out: list[Column] = []
    for i, c in enumerate(columns):
        for a in alphas:
            if a < 1.0:
                k = fading.index(a)
                value = F.try_divide(total(f"_n{i}_{k}", a), total(f"_d{i}_{k}", a))
            else:
                value = F.col(f"`{c}`").cast("double")
            out.append(value.alias(ema_name(c, a)))
    return summed.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def smoothing_and_extremes(
    df: DataFrame,
    spec: PanelSpec,
    columns: Sequence[str],
    alphas: Sequence[float] = fixed.EMA_ALPHAS,
    windows: Sequence[int] = fixed.EXTREME_WINDOWS,
) -> DataFrame:
    """Add exponential averages and rolling maxima and minima of the columns present."""
    columns = [c for c in columns if c in df.columns]
    history = f"PARTITION BY `{spec.id}` ORDER BY `{spec.period}`"
    extremes, names = [], []
    for c in columns:
        names += [ema_name(c, a) for a in alphas]
        for n in windows:
            frame = f"OVER ({history} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            for f in ("max", "min"):
                names.append(f"{c}_{f}_win{n}")
                extremes.append(F.expr(f"{f}(`{c}`) {frame} AS `{names[-1]}`"))
    added = with_ema(df.select("*", *extremes), spec, columns, alphas)
    return added.select(*[F.col(f"`{c}`") for c in [*df.columns, *names]])


def smoothed_groups(
    groups: dict[str, list[str]] = fixed.BANK_GROUPS,
    skip: Sequence[str] = fixed.BANK_GROUPS_NOT_SMOOTHED,
) -> list[str]:
    return [g for g in groups if g not in skip]


def features_v2(
    df: DataFrame, spec: PanelSpec, groups: dict[str, list[str]] = fixed.BANK_GROUPS
) -> DataFrame:
    """Group sums, then lags and deltas of every numeric column."""
    return lags_and_deltas(group_sums(df, groups), spec)


def features_v3(
    df: DataFrame,
    spec: PanelSpec,
    groups: dict[str, list[str]] = fixed.BANK_GROUPS,
    not_smoothed: Sequence[str] = fixed.BANK_GROUPS_NOT_SMOOTHED,
    first_period: int | None = fixed.FIRST_KEPT_PERIOD,
) -> DataFrame:
    """Group sums, smoothing and extremes, then lags and deltas of the underived columns.

    Periods before ``first_period`` are dropped last, so that the first rows kept still
    look back at them.
    """
    summed = group_sums(df, groups)
    smoothed = smoothing_and_extremes(summed, spec, smoothed_groups(groups, not_smoothed))
    lagged = lags_and_deltas(
        smoothed, spec, lag_candidates(smoothed, spec, fixed.DERIVED_MARKS)
    )
    return lagged if first_period is None else lagged.filter(F.col(spec.period) >= first_period)
