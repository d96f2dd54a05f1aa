import gzip
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import sql_steps
from tidemark.sources import panels as sources
from tidemark.sources import staging
from tidemark.spec import PanelSpec

SPEC = PanelSpec("customer", "month", "class")


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(1, 202101, 5.5, "BAJA+1"), (2, 202101, None, "CONTINUA"), (1, 202102, 7.0, None)]
    return spark.createDataFrame(rows, "customer long, month int, x double, class string")


def test_parquet_and_csv_round_trips(spark, panel, tmp_path):
    sources.write_parquet(panel, str(tmp_path / "p.parquet"))
    sources.write_csv(panel, str(tmp_path / "p.csv"))
    for path in ("p.parquet", "p.csv"):
        again = sources.read_panel(spark, str(tmp_path / path), SPEC, schema=None)
        assert sources.same_shape(panel, again)
        assert again.select(panel.columns).exceptAll(panel).count() == 0


def test_partitioned_sink(spark, panel, tmp_path):
    path = tmp_path / "by_month.parquet"
    sources.write_parquet(panel, str(path), period="month")
    assert {p.name for p in path.iterdir() if p.is_dir()} == {"month=202101", "month=202102"}
    assert spark.read.parquet(str(path)).count() == 3


def test_compressed_csv_and_suffix_rules(spark, tmp_path):
    path = tmp_path / "in.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("customer,month,x\n1,202101,2.5\n")
    row = sources.read_panel(spark, str(path), SPEC, "customer long, month int, x double").first()
    assert tuple(row) == (1, 202101, 2.5)
    with pytest.raises(ValueError, match="unsupported"):
        sources.read_panel(spark, str(tmp_path / "in.xlsx"))
    plain = tmp_path / "in.txt"
    plain.write_text("customer,month\n1,202101\n")
    assert sources.read_panel(spark, str(plain), SPEC, other_as_csv=True).count() == 1
    with pytest.raises(ValueError, match="missing"):
        sources.read_panel(spark, str(plain), PanelSpec("nobody", "month"), other_as_csv=True)


def test_names_round_trip(panel):
    standard = sources.standard_names(panel, SPEC)
    assert standard.columns[:2] == ["entity_id", "period"]
    assert sources.original_names(standard, SPEC).columns == panel.columns


def test_append(spark, panel):
    new = spark.createDataFrame([("CONTINUA", 9, 202103, 1.0)], "class string, customer long, month int, x double")
    whole = sources.append_snapshot(panel, new)
    assert whole.count() == 4 and whole.columns == panel.columns
    with pytest.raises(ValueError, match="columns differ"):
        sources.append_snapshot(panel, new.drop("x"))


def test_prediction_files(spark, tmp_path):
    spec = PanelSpec("id", "period")
    scored = spark.createDataFrame([(1, 202101, 0.9, 1)], "id long, period int, score double, contact int")
    sources.write_predictions(scored, spec, str(tmp_path / "out"))
    contacts = spark.read.option("header", True).csv(str(tmp_path / "out" / "contacts"))
    assert contacts.columns == ["id", "Predicted"]
    assert spark.read.parquet(str(tmp_path / "out" / "detail")).count() == 1


def test_staging_uses_the_checkpoint_folder(spark, panel):
    staged = staging.stage(panel)
    folder = staging.staging_dir(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert folder.split(":")[-1] in staged.inputFiles()[0]
    assert staged.exceptAll(panel).count() == 0 and staged.schema == panel.schema
    assert staging.drop_staged(spark) >= 1


def test_staged_tables_end_with_their_scope(spark, panel):
    outer = staging.stage(panel)
    with staging.staging_scope(spark):
        inner = staging.stage(panel)
        with staging.staging_scope(spark):
            staging.stage(panel)
        assert inner.count() == panel.count()
        folder = inner.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        assert os.path.isdir(folder.replace("//", "/"))
    assert not os.path.isdir(folder.replace("//", "/"))
    assert outer.count() == panel.count()
    assert staging.drop_staged(spark) >= 1


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_dir(Session())


STEPS = [
    sql_steps.Step(
        "typed", "SELECT *, CAST({period_col} AS BIGINT) AS month_number FROM {base_table}"
    ),
    sql_steps.Step(
        "lagged",
        "SELECT *, lag(x) OVER (PARTITION BY {id_col} ORDER BY month_number) AS x_before FROM typed",
    ),
    sql_steps.Step(
        "result",
        "SELECT {id_col} AS who, {period_col} AS at, {target_col} AS target, x - x_before AS moved FROM lagged",
    ),
]


def test_sql_steps(spark, panel):
    sources.register(panel, "base_panel")
    out = sql_steps.run_steps(spark, STEPS, sql_steps.parameters(SPEC, "base_panel"))
    assert out.columns == ["who", "at", "target", "moved"]
    assert {(r["who"], r["at"]): r["moved"] for r in out.collect()} == {
        (1, 202101): None, (1, 202102): 1.5, (2, 202101): None,
    }


def test_sql_step_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sql_steps.read_step(tmp_path / "none.sql")
    (tmp_path / "one.sql").write_text("SELECT 1 AS a")
    assert sql_steps.read_step(tmp_path / "one.sql").name == "one"
    with pytest.raises(ValueError):
        sql_steps.run_steps(spark, [], {})
    with pytest.raises(ValueError, match="identifier"):
        sql_steps.render("SELECT * FROM {base_table}", {"base_table": "x; DROP TABLE y"})
