"""Exact ranks and running totals over data of any size.

A window without PARTITION BY, or with few and huge groups, puts a whole table or a whole
period into one task.  Here the sort order is cut into *slices* first: a slice is a range of
the order, numbered in that order, and holds a bounded share of all rows.  Rank and running
total are then

    value inside the slice (window per slice)  +  total of the slices before it,

where the slice totals are one small aggregate.  Slices come from approximate quantiles of
the sort key, or from a hash prefix when the order is a hash.  The cut points only balance
the work; the results are exact for every choice of them.

A single key value may hold any share of the rows.  Such a value is a slice range of its own
and is divided further by the tie-breaker, which is unique within the group.

Slices are cut on a number that grows with the key, rows are ordered by the key itself: keys that
a double cannot tell apart (64-bit, decimal, text) keep their order.  NULL and NaN come last
in either direction, and a NULL group is a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLICE = "_slice"
_RANGE = "_range"
_SINGLE = "_single_value"
_KEY = "_key"
_TIE = "_tie"
_GROUP = "_group"

SAMPLE_PER_SLICE = 500
SAMPLE_TASKS = 16
#: rows of a slice, about: what one window task sorts
ROWS_PER_SLICE = 500_000
_EXACT = 2**53


def slice_count(rows: int) -> int:
    """Slices for so many rows; 16 at least."""
    return max(16, -(-rows // ROWS_PER_SLICE))


def numeric_image(column: Column, kind: T.DataType) -> Column:
    """A double that never falls as the column grows."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8") if isinstance(kind, T.StringType) else column, 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return column.cast("double")


def _ordered(column: str, kind: T.DataType, descending: bool = False) -> Column:
    """Sort order of a column, NULL and NaN last either way."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(F.col(column) == 0, F.lit(0.0)).otherwise(F.col(column))  # one zero
        return (-value if descending else value).asc_nulls_last()
    return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()


def _told_apart(df: DataFrame, column: str) -> bool:
    """Whether different values of the column have different numeric images."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.LongType, T.DecimalType)):
        if isinstance(kind, T.DecimalType) and kind.scale > 0:
            return kind.precision <= 15
        largest = df.agg(F.max(F.abs(F.col(column).cast("decimal(38,0)")))).first()[0]
        return largest is None or largest <= _EXACT
    return not isinstance(kind, (T.StringType, T.BinaryType, T.TimestampType))


def cut_points(
    df: DataFrame, columns: Sequence[str], grid: Sequence[float], error: float, sample_rows: int
) -> list[list[float]]:
    """Approximate quantiles of several columns in one pass, in order, duplicates kept.

    They only serve as cut points, so a sample is enough, as in Spark's own range
    partitioning.  It keeps the merging of the quantile sketches small however many files the
    table has.  Counting a Parquet table reads footers.
    """
    chosen = df.select(*columns)
    rows = chosen.count()
    if rows > sample_rows:
        chosen = chosen.sample(sample_rows / rows, seed=17).repartition(SAMPLE_TASKS)
    probs = ", ".join(f"{p!r}D" for p in grid)
    number = "CASE WHEN NOT isnan(CAST(`{0}` AS DOUBLE)) THEN CAST(`{0}` AS DOUBLE) END"
    found = chosen.selectExpr(
        *[
            f"percentile_approx({number.format(c)}, array({probs}), {round(1 / error)}) AS _q{i}"
            for i, c in enumerate(columns)
        ]
    ).first()
    return [list(q or []) for q in found]


def bucket_edges(quantiles: Sequence[float]) -> tuple[list[float], dict[int, int]]:
    """Bucket edges, and the buckets of one single value with their number of grid positions.

    A value that fills more than one position of the grid is frequent; it gets the bucket
    [v, next double after v).
    """
    positions_of: dict[float, int] = {}
    for q in quantiles:
        if math.isfinite(q):
            positions_of[q] = positions_of.get(q, 0) + 1
    frequent = {v: n for v, n in positions_of.items() if n > 1}
    finite = sorted({*positions_of, *(math.nextafter(v, math.inf) for v in frequent)})
    finite = [e for e in finite if math.isfinite(e)]
    singles = {i + 1: frequent[e] for i, e in enumerate(finite) if e in frequent}
    return [-math.inf, *finite, math.inf], singles


def bucketed(df: DataFrame, columns: dict[str, tuple[str, Sequence[float]]]) -> DataFrame:
    """Add bucket number columns: ``{output: (input, splits)}``; NULL stays NULL.

    NaN gets the number after the last bucket.
    """
    cut = {o: v for o, v in columns.items() if len(v[1]) > 2}
    if cut:
        df = Bucketizer(
            splitsArray=[list(s) for _, s in cut.values()],
            inputCols=[c for c, _ in cut.values()],
            outputCols=list(cut),
            handleInvalid="keep",
        ).transform(df)
    whole = {o: F.when(F.col(v[0]).isNotNull(), F.lit(0.0)) for o, v in columns.items() if o not in cut}
    return df.withColumns(whole) if whole else df


def sliced_by_value(
    df: DataFrame, key: str, tie: str, slices: int | None = None, descending: bool = False
) -> DataFrame:
    """Add slice columns for the order (key, NaN and NULL last; tie ascending).

    ``tie`` divides the rows of a frequent key value, where the key's numeric image tells
    values apart; else such a value stays in one slice.
    """
    slices = slices or slice_count(df.count())
    divide = _told_apart(df, key)
    image = numeric_image(F.col(key), df.schema[key].dataType)
    image = -image if descending else image
    image = F.when(image == 0, F.lit(0.0)).otherwise(image)  # one zero: -0.0 sorts like 0.0
    df = df.withColumns({_KEY: image, _TIE: numeric_image(F.col(tie), df.schema[tie].dataType)})
    grid = [i / slices for i in range(1, slices)]
    key_quantiles, tie_quantiles = cut_points(
        df, [_KEY, _TIE], grid, 1.0 / (4 * slices), SAMPLE_PER_SLICE * slices
    )
    key_splits, single = bucket_edges(key_quantiles)
    tie_splits, _ = bucket_edges(tie_quantiles)
    df = bucketed(df, {_RANGE: (_KEY, key_splits), "_part": (_TIE, tie_splits)})

    # A frequent value is divided in proportion to its share, NaN and NULL as if they were
    # everything: the slices of all values together stay within five times ``slices``.
    null_range, tie_parts = len(key_splits), len(tie_splits)
    shares = [single.get(i, 0) for i in range(null_range - 1)] + [slices, slices]
    number = F.coalesce(F.col(_RANGE), F.lit(null_range)).cast("int")
    share = F.element_at(F.lit(shares), number + 1)
    # rows without a tie value go last, as their order has it
    place = F.coalesce("_part", F.lit(tie_parts - 1))
    part = F.floor(place * share / tie_parts) if divide else F.lit(0).cast("bigint")
    return df.withColumns(
        {
            _SINGLE: (share > 0) if divide else F.lit(False),
            _RANGE: number.cast("bigint"),
            _SLICE: number.cast("bigint") * (slices + 1) + part,
        }
    ).drop("_part")


def sliced_by_hash(df: DataFrame, key: Column, digits: int | None = None) -> DataFrame:
    """Add slice columns for the order of a hexadecimal hash: its first digits.

    As many digits as cut the rows into parts of :data:`ROWS_PER_SLICE`; three at least.
    """
    if digits is None:
        digits = max(3, math.ceil(math.log(max(df.count(), 1) / ROWS_PER_SLICE, 16)))
    return df.withColumns({_KEY: key}).withColumn(
        _SLICE, F.conv(F.substring(_KEY, 1, digits), 16, 10).cast("bigint")
    )


def hash_key(columns: Sequence[str], seed: int) -> Column:
    """A reproducible pseudo-random order: the MD5 digest of the columns and the seed."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _slice_totals(df: DataFrame, group: list[str], sums: dict[str, str], extra: list[str]) -> DataFrame:
    """One row per group and slice with the rows and sums of the slices before it."""
    counted = df.groupBy(*group, *extra, _SLICE).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    )
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        *group,
        *extra,
        _SLICE,
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_n").over(whole).alias("_group_size"),
        *[
            F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}")
            for n in sums
        ],
    )


def _grouped(df: DataFrame, group: list[str]) -> tuple[DataFrame, list[str]]:
    """The group as one struct: a NULL in it equals a NULL, and a window and a plain equi-join
    on it share their shuffle."""
    return (df.withColumn(_GROUP, F.struct(*group)), [_GROUP]) if group else (df, [])


def positions(
    sliced: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    row: str = "row_in_group",
    running: dict[str, str] | None = None,
) -> DataFrame:
    """Add the row number, and running totals ``{name: column}``, in ``order`` per group.

    ``sliced`` carries slice columns consistent with ``order``.  The window and the join
    with the slice totals use the same keys, so the rows are shuffled once.
    """
    running = running or {}
    sliced, group = _grouped(sliced, list(group))
    local = Window.partitionBy(*group, _SLICE).orderBy(*order)
    up_to = local.rowsBetween(Window.unboundedPreceding, 0)
    inside = sliced.select(
        "*",
        F.row_number().over(local).cast("bigint").alias("_row"),
        *[F.sum(c).over(up_to).alias(f"_run_{n}") for n, c in running.items()],
    )
    totals = _slice_totals(sliced, group, running, [])
    drop = [_SLICE, _KEY, _TIE, _RANGE, _SINGLE, _GROUP]
    kept = [c for c in sliced.columns if c not in drop]
    return inside.join(totals, [*group, _SLICE]).select(
        *kept,
        (F.col("_rows_before") + F.col("_row")).alias(row),
        *[(F.col(f"_before_{n}") + F.col(f"_run_{n}")).alias(n) for n in running],
    )


def rank_rows(
    df: DataFrame,
    key: str,
    tie: str | Sequence[str],
    group: Sequence[str] = (),
    descending: bool = False,
    row: str = "rank",
    running: dict[str, str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Rank 1..n by ``key`` (ties by the ``tie`` columns), over all rows or within groups."""
    ties = [tie] if isinstance(tie, str) else list(tie)
    sliced = sliced_by_value(df, key, ties[0], slices, descending)
    order = [_ordered(key, df.schema[key].dataType, descending), *[_ordered(t, df.schema[t].dataType) for t in ties]]
    return positions(sliced, order, group, row, running)


def standing(
    df: DataFrame, key: str, tie: str, group: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Add row_in_group, rank_in_group (ties share the first row), peers_end (last row of
    the ties) and group_size for ``key`` ascending, NULL last."""
    sliced, group = _grouped(sliced_by_value(df, key, tie, slices), list(group))
    by_key = _ordered(key, df.schema[key].dataType)
    local = Window.partitionBy(*group, _SLICE)
    inside = sliced.select(
        "*",
        F.row_number().over(local.orderBy(by_key, _ordered(tie, df.schema[tie].dataType))).cast("bigint").alias("_row"),
        F.rank().over(local.orderBy(by_key)).cast("bigint").alias("_rank"),
        F.count(F.lit(1)).over(local.orderBy(by_key)).alias("_peers"),
    )
    totals = _slice_totals(sliced, group, {}, [_RANGE])
    of_range = Window.partitionBy(*group, _RANGE)
    totals = totals.select(
        *group,
        _SLICE,
        "_rows_before",
        "_group_size",
        F.min("_rows_before").over(of_range).alias("_range_start"),
        F.max(F.col("_rows_before") + F.col("_n")).over(of_range).alias("_range_end"),
    )
    single = F.col(_SINGLE)
    return inside.join(totals, [*group, _SLICE]).select(
        *df.columns,
        (F.col("_rows_before") + F.col("_row")).alias("row_in_group"),
        F.when(single, F.col("_range_start") + 1)
        .otherwise(F.col("_rows_before") + F.col("_rank"))
        .alias("rank_in_group"),
        F.when(single, F.col("_range_end"))
        .otherwise(F.col("_rows_before") + F.col("_peers"))
        .alias("peers_end"),
        F.col("_group_size").alias("group_size"),
    )
