import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import drift, sketches
from tidemark.sources import monthly
from tidemark.spec import PanelSpec

SPEC = PanelSpec("id", "month")


def panel(spark, months=(1, 2, 3, 4), n=50):
    rows = [(i, m, float((i * 7 + m * 3) % 11)) for i in range(n) for m in months if (i + m) % 4]
    return spark.createDataFrame(rows, "id long, month int, x double")


def test_a_month_written_twice_is_there_once_and_others_stay(spark, tmp_path):
    path, df = str(tmp_path / "panel"), panel(spark)
    monthly.append_period(df.where("month < 4"), path, "month")
    for _ in range(2):
        monthly.append_period(df.where("month = 4"), path, "month")
    key = lambda r: (r["id"], r["month"])
    stored = spark.read.parquet(path).select(*df.columns)
    assert sorted(stored.collect(), key=key) == sorted(df.collect(), key=key)
    monthly.append_period(df.where("month = 2").limit(3), path, "month")
    assert spark.read.parquet(path).groupBy("month").count().where("month = 2").first()["count"] == 3
    recent = monthly.read_history(spark, path, "id", "month", 3, 2)
    assert {r["month"] for r in recent.collect()} == {2, 3}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan)


def test_an_incremental_month_equals_a_rebuild(spark, tmp_path):
    df = panel(spark)
    history = Window.partitionBy("id").orderBy("month")
    lags = [F.lag("x", k).over(history).alias(f"x_lag{k}") for k in (1, 2)]
    full = df.select("*", *lags).select("*", *[(F.col("x") - F.col(f"x_lag{k}")).alias(f"x_d{k}") for k in (1, 2)])
    state = monthly.carried_rows(df.where("month = 1"), SPEC, ["x"])
    for month in (2, 3, 4):
        path = str(tmp_path / str(month))
        state.write.parquet(f"{path}/state")
        monthly.append_period(df.where(F.col("month") == month), f"{path}/panel", "month")
        new = monthly.new_month_lags(spark, path, SPEC, ["x"], month).select(*full.columns)
        assert sorted(map(tuple, new.collect()), key=repr) == sorted(map(tuple, full.where(F.col("month") == month).collect()), key=repr)
        state = monthly.rolled_rows(spark.read.parquet(f"{path}/state"), df.where(F.col("month") == month), SPEC, ["x"])
    assert sorted(map(str, state.collect())) == sorted(map(str, monthly.carried_rows(df, SPEC, ["x"]).collect()))


def test_bucketed_tables_join_without_an_exchange(spark):
    df = panel(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    monthly.use_stored_partitioning(spark)
    try:
        a = monthly.write_bucketed(df, "monthly_test_a", "id", "month", 4)
        b = monthly.write_bucketed(df.withColumnRenamed("x", "y"), "monthly_test_b", "id", "month", 4)
        joined = a.join(b, ["id", "month"]).select("*", F.sum("x").over(Window.partitionBy("id").orderBy("month")).alias("s"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("a", "b"):
            spark.sql(f"DROP TABLE monthly_test_{t}")


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,month,x\n1,2,3.5\nno,2,1\n4,5\n6,7,8,9\n\n8,9,\n")
    good, wrong = monthly.read_csv_checked(spark, str(folder), "id BIGINT, month INT, x DOUBLE")
    assert sorted(map(tuple, good.collect())) == [(1, 2, 3.5), (8, 9, None)]
    assert sorted(r["line"] for r in wrong.collect()) == ["4,5", "6,7,8,9", "no,2,1"]
    monthly.write_csv_gzip(good, str(tmp_path / "gz"))
    again, none = monthly.read_csv_checked(spark, str(tmp_path / "gz"), good.schema)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, good.collect())) and none.isEmpty()
    assert any(re.search(r"\.csv\.gz$", str(p)) for p in (tmp_path / "gz").iterdir())


def test_merged_sketches_keep_their_rank_error(spark):
    df = spark.range(60_000).select((F.col("id") % 6 + 1).cast("int").alias("month"), F.rand(3).alias("u"), (F.exp(3 * F.randn(4))).alias("skewed"), (F.col("id") % 3).cast("double").alias("few"), F.lit(None).cast("double").alias("never"))
    columns = ["u", "skewed", "few", "never"]
    by_month = [sketches.month_sketches(df.where(F.col("month") == m), "month", columns) for m in range(1, 7)]
    stored = by_month[0]
    for more in by_month[1:]:
        stored = stored.union(more)
    stored = stored.cache()
    assert {r["column"] for r in stored.collect()} == {"u", "skewed", "few"}
    found = sketches.sketch_quantiles(stored, [0.01, 0.1, 0.5, 0.9, 0.99])
    assert found.first()["n"] == 60_000
    assert sketches.rank_errors(df, found).agg(F.max("error")).first()[0] < sketches.RANK_ERROR
    cuts, exact = sketches.sketch_cuts(stored, 10), drift.psi_cuts(df, ["few"], 10)
    assert cuts["few"] == exact["few"] and len(cuts["u"]) == 11
    low, high = sketches.sketch_bounds(stored, 3.0)["u"]
    assert abs(low + 1.25) < 0.1 and abs(high - 2.25) < 0.1
