import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sampling, selection
from tidemark.spec import PanelSpec

SPEC = PanelSpec("id", "period", "target")


@pytest.fixture(scope="module")
def panel(spark):
    target = (
        F.when(F.col("id") % 40 == 0, "BAJA+2")
        .when(F.col("id") % 40 == 1, "BAJA+1")
        .when(F.col("id") % 40 == 2, None)
        .otherwise("CONTINUA")
    )
    return (
        spark.range(2000)
        .select("id", F.lit(202101).alias("period"), target.alias("target"))
        .repartition(5)
        .cache()
    )


def digest(i, seed):
    return hashlib.md5(f"{i}|202101|{seed}".encode()).hexdigest()


def test_undersampling_is_exact_and_reproducible(panel):
    got = sampling.undersample_majority(panel, SPEC, factor=6, seed=9)
    kept = {r["id"] for r in got.filter("target = 'CONTINUA'").collect()}
    assert got.filter("target <> 'CONTINUA'").count() == 100
    assert got.filter("target IS NULL").count() == 0
    majority = [r["id"] for r in panel.filter("target = 'CONTINUA'").collect()]
    assert kept == set(sorted(majority, key=lambda i: digest(i, 9))[:600])


def test_undersampling_null_rule(panel):
    got = sampling.undersample_majority(panel, SPEC, factor=2, keep_null=True)
    counts = {r["target"]: r["count"] for r in got.groupBy("target").count().collect()}
    assert counts[None] == 50 and counts["CONTINUA"] == 2 * 150


def test_undersampling_leaves_small_majorities_alone(panel):
    assert sampling.undersample_majority(panel, SPEC, factor=1000).count() == 2000
    assert sampling.undersample_majority(panel.drop("target"), SPEC).count() == 2000
    # a factor below one counts as one
    assert sampling.undersample_majority(panel, SPEC, factor=0.1).count() == 200


def test_undersampling_without_minority(panel):
    only = panel.filter("target = 'CONTINUA'")
    assert sampling.undersample_majority(only, SPEC).count() == only.count()
    assert sampling.undersample_majority(only, SPEC, sample_when_no_minority=True).count() == 0


def test_folds_are_balanced_within_each_label(panel):
    df = panel.select("id", "period", (F.col("id") % 10 == 0).cast("int").alias("y"))
    folds = sampling.stratified_folds(df, SPEC, "y", folds=5, seed=3)
    sizes = folds.groupBy("y", "fold").count().collect()
    assert {(r["y"], r["fold"]): r["count"] for r in sizes} == {
        (y, f): (40 if y else 360) for y in (0, 1) for f in range(5)
    }
    for y in (0, 1):
        rows = folds.filter(F.col("y") == y).collect()
        ordered = sorted(rows, key=lambda r: digest(r["id"], 3))
        assert [r["fold"] for r in ordered] == [i % 5 for i in range(len(ordered))]


def test_canaries_come_first_and_are_reproducible(panel):
    df = sampling.canary_columns(panel, SPEC, count=3, seed=1)
    assert df.columns == ["canary_1", "canary_2", "canary_3", "id", "period", "target"]
    stats = df.agg(F.min("canary_1"), F.max("canary_1"), F.avg("canary_1"), F.corr("canary_1", "canary_2")).first()
    assert 0 <= stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.03 and abs(stats[3]) < 0.08
    again = sampling.canary_columns(panel.repartition(3), SPEC, count=3, seed=1)
    assert df.exceptAll(again.select(df.columns)).count() == 0


def test_shuffle_keeps_rows(panel):
    shuffled = sampling.shuffle_rows(panel, SPEC)
    assert shuffled.exceptAll(panel).count() == 0 and shuffled.count() == 2000


def test_required_and_unique(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "id long, period int")
    assert selection.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="other"):
        selection.require_columns(df, ["id", "other"])
    with pytest.raises(ValueError):
        selection.require_unique_key(df, ["id", "period"])
    selection.require_unique_key(df.distinct(), ["id", "period"])


def test_numeric_selection(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "id long, s string, b boolean, x double")
    assert selection.select_numeric(df, ["id"]).columns == ["b", "x"]
    with pytest.raises(ValueError):
        selection.select_numeric(df.select("s"))


def test_alignment(spark):
    df = spark.createDataFrame([(1, 5.0, 6.0)], "id long, b double, extra double")
    row = selection.align_features(df, ["a", "b"], keep=["id"]).first()
    assert row.asDict() == {"id": 1, "a": 0.0, "b": 5.0}
    with pytest.raises(KeyError):
        selection.align_features(df, ["a", "b"], strict=True)
    assert selection.drop_if_exists(df, ["extra", "nothing"]).columns == ["id", "b"]


def test_periods(spark):
    df = spark.createDataFrame([(p,) for p in (3, 1, 2, 3)], "period int")
    available = selection.distinct_periods(df, "period")
    assert available == [1, 2, 3]
    default = selection.resolve_periods(available, default_future=[3])
    assert (default.train, default.future, default.overlap) == ([1, 2], [3], [])
    given = selection.resolve_periods(available, train=[1, 3], future=[3])
    assert given.overlap == [3]
    train, future = selection.train_future_split(df, "period", given)
    assert train.count() == 3 and future.count() == 2
    with pytest.raises(ValueError):
        selection.filter_period(df, "period", 9)


def test_period_filter_is_pushed_to_files(spark, tmp_path):
    path = str(tmp_path / "panel")
    spark.range(10).select("id", (F.col("id") % 3).alias("period")).write.partitionBy("period").parquet(path)
    df = selection.filter_periods(spark.read.parquet(path), "period", [1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan or "PartitionFilters: [(period" in plan


def test_class_filters_and_null_targets(spark):
    df = spark.createDataFrame([("CONTINUA",), ("BAJA+1",), (None,)], "target string")
    assert selection.filter_class(df, "target", "CONTINUA").count() == 1
    assert selection.filter_class(df, "target", "CONTINUA", equal=False).count() == 1
    assert selection.filter_class(df, "target", "CONTINUA", equal=False, keep_null=True).count() == 2
