import math

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift


_BINS = """
WITH known AS (SELECT period IN {base} AS is_base, period = {period} AS is_now, x FROM frame WHERE NOT isnan(x)),
edges AS (SELECT list_sort(list_distinct(quantile_cont(x, [i / 10.0 FOR i IN range(11)]))) AS e FROM known WHERE is_base),
placed AS (
  SELECT is_base, is_now, least(len(list_filter(e, lambda v: v <= x)), len(e) - 1) AS bin
  FROM known, edges WHERE x >= e[1] AND x <= e[-1])
SELECT (SELECT len(e) FROM edges), (SELECT count(*) FROM known WHERE is_now), bin,
  count(*) FILTER (WHERE is_base), count(*) FILTER (WHERE is_now)
FROM placed GROUP BY bin ORDER BY bin
"""


def sql_psi(frame, column, period, base):
    """The index from bins that another engine counts: None without values, 0 for one edge."""
    con = duckdb.connect()
    con.register("frame", frame[["period", column]].rename(columns={column: "x"}))
    rows = con.execute(_BINS.format(base=tuple(base), period=period)).fetchall()
    if not rows or not rows[0][1]:
        return None
    if rows[0][0] < 2:
        return 0.0
    of_base, of_now = sum(r[3] for r in rows), sum(r[4] for r in rows)
    if not of_now:
        return None
    shares = [(max(r[3] / of_base, 1e-8), max(r[4] / of_now, 1e-8)) for r in rows]
    return sum((e - a) * math.log(e / a) for e, a in shares)


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(2)
    # so many rows that no wanted quantile of the base is a value itself, where engines round apart
    n, periods = 4002, np.arange(202001, 202009)
    p = rng.choice(periods, n)
    df = pd.DataFrame({"id": np.arange(n), "period": p})
    df["steady"] = rng.normal(size=n)
    df["shifted"] = rng.normal(size=n) + (p - 202001) * 0.4
    df["hot"] = np.where(rng.random(n) < 0.5, 1.0, rng.integers(0, 6, n))
    df["constant"] = 3.0
    df["outside"] = np.where(p == 202001, -999.0, rng.random(n))
    df["missing"] = np.where(p == 202002, np.nan, rng.random(n))
    df["never"] = np.nan
    df["tail"] = np.where(rng.random(n) < 0.03, 1e6, rng.random(n))
    return df


COLUMNS = ["steady", "shifted", "hot", "constant", "outside", "missing", "never", "tail"]


@pytest.fixture(scope="module")
def panel(spark, frame):
    # half of the missing values as NULL, the rest as NaN
    df = spark.createDataFrame(frame)
    for c in ("missing", "never"):
        df = df.withColumn(c, F.when(F.isnan(c) & (F.col("id") % 2 == 0), None).otherwise(F.col(c)))
    return df.repartition(6).cache()


def test_baseline_is_the_last_periods(panel):
    assert drift.baseline_periods(panel, "period", 3) == [202006, 202007, 202008]


@pytest.mark.parametrize("margin", [0.2, 0.002])
def test_psi_equals_sql(panel, frame, margin):
    base = list(range(202004, 202009))
    got = {
        (r["period"], r["column"]): r["psi"]
        for r in drift.psi_by_column_period(panel, "period", COLUMNS, base, margin=margin).collect()
    }
    assert len(got) == 8 * len(COLUMNS)
    for (period, column), value in got.items():
        expected = sql_psi(frame, column, period, base)
        if expected is None:
            assert value is None, (period, column)
        else:
            assert value == pytest.approx(expected, abs=1e-12), (period, column)
    assert got[202001, "outside"] is None and got[202002, "missing"] is None
    assert got[202003, "constant"] == 0.0 and got[202003, "never"] is None


def test_psi_worked_out_by_hand(spark):
    """Base 0..9 gives ten bins of one value; period 2 has five values in the first two bins and
    five in the last: shares 0.3, 0.2 and 0.5 against 0.1 each, seven empty bins against 1e-8."""
    rows = [(1, float(v)) for v in range(10)] + [(2, v) for v in (0.0, 0.5, 0.8, 1.0, 1.5, 8.5, 8.6, 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "period int, x double")
    got = {r["period"]: r["psi"] for r in drift.psi_by_column_period(df, "period", ["x"], [1]).collect()}
    edges = [0.9 * i for i in range(11)]
    bins = [sum(edges[i] <= v < edges[i + 1] for p, v in rows if p == 2) for i in range(9)]
    assert bins == [3, 2, 0, 0, 0, 0, 0, 0, 0]
    full = (0.1 - 0.3) * math.log(0.1 / 0.3) + (0.1 - 0.2) * math.log(0.1 / 0.2) + (0.1 - 0.5) * math.log(0.1 / 0.5)
    assert got[1] == pytest.approx(0.0, abs=1e-12)
    assert got[2] == pytest.approx(full + 7 * (0.1 - 1e-8) * math.log(0.1 / 1e-8), abs=1e-9)


def test_psi_of_identical_distributions_is_zero(spark):
    df = spark.range(400).select(
        (F.col("id") % 4).cast("int").alias("period"), F.floor(F.col("id") / 4).cast("double").alias("x")
    )
    values = [r["psi"] for r in drift.psi_by_column_period(df, "period", ["x"]).collect()]
    assert values == pytest.approx([0.0] * 4, abs=1e-12)


def test_drift_report(panel):
    psi = drift.psi_by_column_period(panel, "period", COLUMNS)
    report = {r["period"]: r for r in drift.drift_by_period(psi, "period", len(COLUMNS)).collect()}
    by_period = {}
    for r in psi.collect():
        by_period.setdefault(r["period"], []).append(r["psi"])
    for period, values in by_period.items():
        known = [v for v in values if v is not None]
        row = report[period]
        assert row["avg_psi"] == pytest.approx(sum(known) / len(known))
        assert row["max_psi"] == pytest.approx(max(known))
        over = sum(v > 0.3 for v in known)
        assert row["columns_over_high"] == over
        assert row["drift_flag"] == (row["avg_psi"] > 0.2 or over > 0.2 * len(COLUMNS))


def test_outlier_rates_equal_pandas(panel, frame):
    rates = drift.outlier_rate_by_column_period(panel, "period", COLUMNS)
    got = {(r["period"], r["column"]): r["outlier_rate"] for r in rates.collect()}
    for c in COLUMNS:
        q1, q3 = frame[c].quantile(0.25), frame[c].quantile(0.75)
        low, high = q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1)
        for period, values in frame.groupby("period")[c]:
            if values.isna().all():
                assert got[period, c] is None
            else:
                expected = ((values < low) | (values > high)).mean()
                assert got[period, c] == pytest.approx(expected), (period, c)
    report = drift.outlier_by_period(rates, "period", len(COLUMNS)).collect()
    assert len(report) == 8


def test_bad_periods_and_panel_without_them(spark):
    a = spark.createDataFrame([(1, True), (2, False), (3, False)], "period int, drift_flag boolean")
    b = spark.createDataFrame([(1, True), (2, True), (3, False)], "period int, outlier_flag boolean")
    bad = drift.periods_to_drop(a, b, "period")
    assert sorted(r[0] for r in bad.collect()) == [1, 2]
    rows = spark.createDataFrame([(1, 7), (3, 8)], "period int, x int")
    assert [tuple(r) for r in drift.without_periods(rows, bad, "period").collect()] == [(3, 8)]


def test_values_are_binned_by_column_not_by_row(spark):
    """Odd values and periods, in one pass whose rows are counters: no row per value."""
    inf, nan = float("inf"), float("nan")
    rows = [(1, 0.0, 5.0), (1, 1.0, 5.0), (1, 2.0, None), (1, 4.0, 5.0), (2, -0.0, nan), (2, 4.0, 7.0), (2, inf, None), (2, None, 5.0), (None, 1.5, 5.0), (None, nan, 5.0)]
    cuts = [[0.0, 1.0, 2.0, 4.0], [5.0]]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.float64(), pa.float64()))], ["p", "x", "y"])
    found = [r for b in drift._binned("p", cuts)([batch, batch.slice(0, 4)]) for r in b.to_pylist()]
    got = {(r["p"], r["column"], r["bin"]): r["n"] for r in found}
    assert got == {
        (1, 0, 1): 2, (1, 0, 2): 2, (1, 0, 3): 4, (2, 0, 1): 1, (2, 0, 3): 1, (2, 0, 0): 1, (2, 0, -1): 1, (None, 0, 2): 1, (None, 0, -1): 1,
        (1, 1, 0): 6, (1, 1, -1): 2, (2, 1, -1): 2, (2, 1, 0): 2, (None, 1, 0): 2,
    }
    df = spark.createDataFrame(rows, "p int, x double, y double")
    plan = drift.psi_by_column_period(df, "p", ["x", "y"], [1])._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(array(cast" not in plan and "MapInArrow" in plan
