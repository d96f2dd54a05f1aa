import math
import random
from datetime import date
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import PanelSpec
from tidemark.operators import quantiles, ranking, sampling


def skewed(spark, n=3000, seed=5, with_null=True):
    """A third of all rows has one value, another share is NULL, a third of them one group."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        u = rng.random()
        value = 7.25 if u < 0.35 else (None if with_null and u < 0.45 else round(rng.gauss(0, 50), 1))
        rows.append((i * 3, 1 if rng.random() < 0.4 else rng.randint(2, 9), value, rng.randint(-5, 5)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, grp int, x double, v int").repartition(7).cache()


@pytest.mark.parametrize("slices", [2, 16, 200])
@pytest.mark.parametrize("group", [[], ["grp"]])
def test_rank_rows_equals_plain_window(spark, slices, group):
    df = skewed(spark)
    order = [F.col("x").desc_nulls_last(), F.col("id")]
    w = Window.partitionBy(*(group or [F.lit(1)])).orderBy(*order)
    expected = df.select(
        "id",
        F.row_number().over(w).alias("n"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
    )
    got = ranking.rank_rows(
        df, "x", "id", group, descending=True, row="n", running={"s": "v"}, slices=slices
    )
    assert set(got.columns) == {"id", "grp", "x", "v", "n", "s"}
    assert sorted(map(tuple, got.select("id", "n", "s").collect())) == sorted(
        map(tuple, expected.collect())
    )


@pytest.mark.parametrize("slices", [2, 16, 200])
def test_standing_equals_plain_windows(spark, slices):
    df = skewed(spark)
    by_key = Window.partitionBy("grp").orderBy(F.col("x").asc_nulls_last())
    by_id = Window.partitionBy("grp").orderBy(F.col("x").asc_nulls_last(), "id")
    expected = df.select(
        "id",
        F.row_number().over(by_id).alias("r"),
        F.rank().over(by_key).alias("k"),
        F.count(F.lit(1)).over(by_key).alias("p"),
        F.count(F.lit(1)).over(Window.partitionBy("grp")).alias("g"),
    )
    got = ranking.standing(df, "x", "id", ["grp"], slices=slices).select(
        "id", "row_in_group", "rank_in_group", "peers_end", "group_size"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_no_slice_holds_a_hot_value(spark):
    df = skewed(spark, n=4000)
    sliced = ranking.sliced_by_value(df, "x", "id", slices=20)
    sizes = sliced.groupBy("_slice").count().agg(F.max("count"), F.count("count")).first()
    assert sizes[0] <= 3 * 4000 / 20
    assert sizes[1] <= 4 * 20


def test_sampled_cut_points_change_no_result(spark, monkeypatch):
    df = skewed(spark)
    expected = sorted(map(tuple, ranking.rank_rows(df, "x", "id", slices=8).collect()))
    monkeypatch.setattr(ranking, "SAMPLE_PER_SLICE", 20)
    got = sorted(map(tuple, ranking.rank_rows(df, "x", "id", slices=8).collect()))
    assert got == expected


def test_constant_and_empty_keys(spark):
    same = spark.range(50).select("id", F.lit(1.0).alias("x"))
    got = ranking.rank_rows(same, "x", "id").orderBy("rank").collect()
    assert [r["id"] for r in got] == list(range(50))
    nulls = spark.range(20).select("id", F.lit(None).cast("double").alias("x"))
    got = ranking.rank_rows(nulls, "x", "id").orderBy("rank").collect()
    assert [r["id"] for r in got] == list(range(20))
    assert ranking.rank_rows(same.limit(0), "x", "id").count() == 0


@pytest.mark.parametrize("slices", [2, 40])
def test_zero_signs_and_nan(spark, slices):
    values = [0.0, -0.0, float("nan"), None, 1.0, -1.0]
    rows = [(i, values[(i * 7) % 6]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double").repartition(3).cache()
    by_key = Window.partitionBy(F.lit(1)).orderBy(F.col("x").asc_nulls_last())
    by_id = Window.partitionBy(F.lit(1)).orderBy(F.col("x").asc_nulls_last(), "id")
    expected = df.select(
        "id", F.row_number().over(by_id), F.rank().over(by_key), F.count(F.lit(1)).over(by_key)
    )
    one = df.withColumn("g", F.lit(1))
    got = ranking.standing(one, "x", "id", ["g"], slices=slices).select(
        "id", "row_in_group", "rank_in_group", "peers_end"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_bucket_edges_isolate_frequent_values():
    splits, single = ranking.bucket_edges([1.0, 2.0, 2.0, 2.0, 5.0])
    assert splits == [-math.inf, 1.0, 2.0, math.nextafter(2.0, math.inf), 5.0, math.inf]
    assert single == {2: 3}


PROBS = [i * 0.1 for i in range(10)] + [1.0]


@pytest.mark.parametrize("margin", [0.3, 0.02, 0.0005])
def test_exact_percentiles_equal_numpy(spark, margin):
    rng = np.random.default_rng(11)
    n = 2500
    hot = np.where(rng.random(n) < 0.4, 3.0, rng.normal(size=n) * 1e6)
    frame = pd.DataFrame(
        {
            "hot": hot,
            "whole": rng.integers(0, 12, n).astype(float),
            "wide": rng.lognormal(3, 4, n),
            "holes": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
            "same": np.full(n, 4.5),
        }
    )
    df = spark.createDataFrame(frame).withColumn("none", F.lit(None).cast("double")).repartition(5)
    got = quantiles.exact_percentiles(df, [*frame.columns, "none"], PROBS, margin)
    assert got["none"] is None
    for c in frame.columns:
        expected = np.quantile(frame[c].dropna(), PROBS)
        np.testing.assert_allclose(got[c], expected, rtol=1e-13, err_msg=c)


def test_misplaced_edges_change_no_quantile(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(quantiles, "cut_points", lambda *a: [[-5.0, 3.0, 990.5]])
    assert quantiles.exact_percentiles(df, ["x"], [0.0, 0.5, 1.0])["x"] == [0.0, 499.5, 999.0]


def test_exact_percentiles_of_few_rows(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert quantiles.exact_percentiles(df, ["x"], [0.0, 0.25, 1.0])["x"] == [1.0, 1.25, 2.0]
    assert quantiles.exact_percentiles(df.limit(0), ["x"], [0.5])["x"] is None


@pytest.mark.parametrize("final_rows", [1, 40, 100_000])
def test_nth_smallest_hash(spark, monkeypatch, final_rows):
    monkeypatch.setattr(sampling, "_FINAL_ROWS", final_rows)
    df = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("h")).cache()
    ordered = sorted(r["h"] for r in df.collect())
    for n in (1, 2, 777, 3000):
        assert sampling.nth_smallest_hash(df, "h", n) == ordered[n - 1]
    with pytest.raises(ValueError):
        sampling.nth_smallest_hash(df, "h", 3001)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize(
    "kind, make",
    [
        ("long", lambda i: 2**53 + i % 40),
        ("long", lambda i: -(2**62) + i % 40),
        ("decimal(38,3)", lambda i: Decimal(2**60 + i % 40) + Decimal("0.001")),
        ("string", lambda i: f"prefix-{i % 40:03d}" if i % 3 else "é" + str(i % 7)),
        ("date", lambda i: date(2020, 1, 1 + i % 28)),
        ("double", lambda i: [float("nan"), 0.5, -0.5, 1e300, 0.0][i % 5]),
    ],
)
def test_keys_and_ties_of_any_type(spark, kind, make, descending):
    """Keys beyond 2^53, text and missing values; string ids; a NULL group."""
    rows = [(f"id{i * 37 % 1000:04d}", None if i % 4 == 0 else i % 2, None if i % 11 == 0 else make(i)) for i in range(400)]
    df = spark.createDataFrame(rows, f"id string, grp int, x {kind}").repartition(3).cache()
    got = ranking.rank_rows(df, "x", "id", ["grp"], descending=descending, row="n", slices=8)
    missing = F.isnan("x") | F.col("x").isNull() if kind == "double" else F.col("x").isNull()
    value = F.col("x").desc_nulls_last() if descending else F.col("x").asc_nulls_last()
    nulls = F.col("x").isNull()
    w = Window.partitionBy("grp").orderBy(missing, nulls, value, "id")
    expected = df.select("id", "grp", F.row_number().over(w).alias("n"))
    assert sorted(map(repr, map(tuple, got.select("id", "grp", "n").collect()))) == sorted(map(repr, map(tuple, expected.collect())))


def test_standing_keeps_a_null_group(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else 1, float(i % 5)) for i in range(100)], "id long, g int, x double")
    got = ranking.standing(df, "x", "id", ["g"], slices=4).collect()
    assert len(got) == 100 and {r["group_size"] for r in got if r["g"] is None} == {25}


def test_folds_keep_rows_without_a_label(spark):
    spec = PanelSpec(id="id", period="p", target="y")
    df = spark.createDataFrame([(f"c{i}", 1, None if i % 5 == 0 else i % 2) for i in range(100)], "id string, p int, y int")
    got = sampling.stratified_folds(df, spec, "y").collect()
    assert len(got) == 100
    assert all(sum(r["y"] is None and r["fold"] == k for r in got) == 4 for k in range(5))
