"""Exact quantiles of many columns without collecting a column anywhere.

The built-in ``percentile`` keeps every distinct value of a group in one task.  Here

1. approximate quantiles put a narrow bracket around each wanted probability,
2. one counting pass over the buckets between these edges finds, exactly, in which bucket each
   wanted order statistic lies and at which position,
3. a second pass keeps only the values in those buckets, counts equal ones map-side, and
   picks the positions.

An edge that is off only makes the last pass keep more; the result is exact in any case.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import staged
from .ranking import cut_points, rank_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARGIN = 0.002


def long_values(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """One row per row and column: the kept columns, ``column`` (its position) and ``value``; NULL is a row too."""
    listed = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in columns)
    return df.select(*keep, F.expr(f"posexplode(array({listed})) AS (column, value)"))


def per_column(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table with a few numbers for every column, to join with :func:`long_values`.

    Its size follows from columns x edges, never from the data, so it may be broadcast.
    """
    return F.broadcast(spark.createDataFrame(rows, f"column int, {schema}"))


def doubles(batch: pa.RecordBatch, i: int) -> np.ndarray:
    """A column of doubles, NULL as NaN."""
    return batch.column(i).to_numpy(zero_copy_only=False).astype(float, copy=False)


def _bucket_counts(edges: Sequence[Sequence[float]]):
    """Values by column and bucket (the edges at or below the value), one row each and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = [np.array(e, float) for e in edges]
        total = [np.zeros(len(e) + 1, np.int64) for e in cuts]
        for batch in batches:
            for i, e in enumerate(cuts):
                x = doubles(batch, i)
                total[i] += np.bincount(np.searchsorted(e, x[~np.isnan(x)], "right"), minlength=len(e) + 1)
        found = [(i, int(b), int(n[b])) for i, n in enumerate(total) for b in np.flatnonzero(n)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), (pa.int32(), pa.int32(), pa.int64()))], ["column", "bucket", "n"])
    return run


def _values_inside(edges: Sequence[Sequence[float]], wanted: Sequence[tuple[int, int]]):
    """The distinct values of the wanted (column, bucket) with their number, by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: dict[int, np.ndarray] = {}
        for i, bucket in wanted:
            chosen.setdefault(i, np.zeros(len(edges[i]) + 1, bool))[bucket] = True
        for batch in batches:
            for i, mine in chosen.items():
                cuts, x = np.array(edges[i], float), doubles(batch, i)
                x = x[~np.isnan(x)]
                values, n = np.unique(x[mine[np.searchsorted(cuts, x, "right")]] + 0.0, return_counts=True)
                buckets = np.searchsorted(cuts, values, "right")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), i, np.int32)), pa.array(buckets.astype(np.int32)), pa.array(values), pa.array(n.astype(np.int64))], ["column", "bucket", "value", "n"])
    return run


def _located(histogram: DataFrame, probs: Sequence[float]) -> list:
    """Bucket, position inside it and interpolation weight of the wanted values.

    A probability whose two neighbouring values lie in different buckets gives two rows.
    """
    ranked = histogram.selectExpr(
        "column",
        "bucket",
        "n",
        "coalesce(sum(n) OVER (PARTITION BY column ORDER BY bucket"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
        "sum(n) OVER (PARTITION BY column) AS total",
    )
    # a projection of its own: rows are multiplied after the windows, not before
    listed = ", ".join(f"{p!r}D" for p in probs)
    wanted = ranked.selectExpr("*", f"explode(array({listed})) AS prob")
    exact = "(total - 1) * prob"
    placed = wanted.selectExpr(
        "column", "bucket", "n", "prob", f"{exact} - floor({exact}) AS weight",
        f"floor({exact}) - before AS low", f"ceil({exact}) - before AS high",
    )
    inside = "({0} >= 0 AND {0} < n)"
    return placed.filter(f"{inside.format('low')} OR {inside.format('high')}").collect()


def _running(counted: DataFrame) -> DataFrame:
    """Add ``last``: the number of values up to each distinct value of its bucket.

    ``counted`` is staged.  A bucket may hold any share of a column, so its order is sliced.
    """
    return rank_rows(
        counted, "value", "value", ["column", "bucket"], row="_row", running={"last": "n"}
    )


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], margin: float = MARGIN
) -> dict[str, list[float] | None]:
    """Quantiles with linear interpolation per column; NULL and NaN are left out.

    ``None`` for a column without values.  ``margin`` is the half width of the brackets.
    Reads ``df`` three times: pass a table or a staged frame.  Only columns x probabilities
    numbers reach the driver.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    df = df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in columns])
    grid = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)})
    quantiles = cut_points(df, columns, grid, margin / 2, int(4 / margin**2))
    sorted_edges = [sorted(map(float, set(q))) for q in quantiles]
    # the columns stay side by side: a value costs a binary search in a task, not a row
    histogram = df.mapInArrow(_bucket_counts(sorted_edges), "column int, bucket int, n bigint").groupBy("column", "bucket").agg(F.sum("n").alias("n"))
    located = _located(histogram, probs)
    wanted = sorted({(r["column"], r["bucket"]) for r in located})
    if not wanted:
        return {c: None for c in columns}
    inside = df.mapInArrow(_values_inside(sorted_edges, wanted), "column int, bucket int, value double, n bigint")
    counted = inside.groupBy("column", "bucket", "value").agg(F.sum("n").alias("n"))
    with staged(counted) as table:
        picked = _values_at(_running(table), located)
    values = {(r["column"], r["prob"]): r["value"] for r in picked}
    return {
        c: [values[i, p] for p in probs] if (i, probs[0]) in values else None
        for i, c in enumerate(columns)
    }


def _values_at(running: DataFrame, located: list) -> list:
    """The interpolated values: (column, prob, value)."""
    # columns x probabilities rows, so adaptive execution broadcasts them
    targets = running.sparkSession.createDataFrame(
        [(r["column"], r["bucket"], r["prob"], r["low"], r["high"], r["weight"]) for r in located],
        "column int, bucket int, prob double, low long, high long, weight double",
    )
    at = "max(CASE WHEN {0} >= last - n AND {0} < last THEN value END) AS {0}"
    return (
        running.join(targets, ["column", "bucket"])
        .groupBy("column", "prob")
        .agg(F.expr(at.format("low")), F.expr(at.format("high")), F.max("weight").alias("weight"))
        .selectExpr("column", "prob", "low + (high - low) * weight AS value")
        .collect()
    )
