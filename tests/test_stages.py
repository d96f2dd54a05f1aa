import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.operators import training
from tidemark.plans import stages
from tidemark.spec import BANK_PANEL, PanelSpec

FAST = {"maxIter": 2, "maxDepth": 2, "maxBins": 16}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """A bank panel of 60 customers over up to 8 months; one in six leaves early."""
    months = F.when(F.col("c") % 6 == 0, F.lit(3) + F.col("c") % 4).otherwise(8)
    base = spark.range(60 * 8).select(
        F.floor(F.col("id") / 8).alias("c"), (F.col("id") % 8).alias("m")
    )
    base = base.filter(F.col("m") < months)
    number = {
        column: ((F.col("c") * 31 + F.col("m") * 17 + i * 7) % 101).cast(
            "long" if role.endswith("count") or role in ("activity", "tenure") else "double"
        )
        for i, (role, column) in enumerate(fixed.BANK_ROLES.items())
    }
    panel = base.select(
        F.col("c").alias("numero_de_cliente"),
        (F.lit(202101) + F.col("m")).cast("int").alias("foto_mes"),
        *[v.alias(c) for c, v in number.items()],
        (F.col("c") * 1.5).alias("mpayroll"),
        F.when(F.col("c") % 6 == 0, 0.0).otherwise(5.0 + F.col("m")).alias("mcaja_ahorro"),
    )
    path = str(tmp_path_factory.mktemp("bank") / "raw.parquet")
    panel.write.parquet(path)
    return path


def test_label_features_campaign(spark, raw, tmp_path):
    labelled, table = str(tmp_path / "labelled.parquet"), str(tmp_path / "features.parquet")
    stages.label_stage(spark, raw, labelled)
    by_class = {r["clase_ternaria"] for r in spark.read.parquet(labelled).select("clase_ternaria").distinct().collect()}
    assert by_class == {"BAJA+1", "BAJA+2", "CONTINUA"}
    stages.feature_stage(spark, labelled, table)
    built = spark.read.parquet(table)
    assert built.count() == spark.read.parquet(raw).count()
    assert {"m_payroll_total_ema_alpha0p3", "m_saldo_total_pesos_max_win12", "mpayroll_lag2"} <= set(built.columns)

    campaign = stages.Campaign(
        future=[202106], train=[202101, 202102, 202103, 202104], seeds=[1, 2], contacts=10,
        canaries=3, params=FAST,
    )
    out = str(tmp_path / "campaign")
    result = stages.campaign_stage(spark, table, out, campaign)
    assert result.scored.filter("contact = 1").count() == 10
    assert result.profit.first()["contacts"] == 10
    contacts = spark.read.option("header", True).csv(f"{out}/predictions/contacts")
    assert contacts.filter("Predicted = 1").count() == 10
    models, manifest = training.load_ensemble(f"{out}/models")
    assert len(models) == 2 and manifest.seeds == [1, 2]
    assert not any(f.startswith("is_") or f in BANK_PANEL.key for f in manifest.features)
    assert sum(manifest.metrics["confusion"].values()) > 0 and manifest.metrics["log_loss"] > 0
    assert result.peak.first()["max_profit"] >= result.profit.first()["profit"]

    # the stored ensemble gives the same ranks as the run that trained it
    again = stages.score_stage(spark, table, f"{out}/models", str(tmp_path / "again"), 202106, contacts=10)
    key = BANK_PANEL.key
    first = {tuple(r[c] for c in key) for r in result.scored.filter("contact = 1").collect()}
    assert {tuple(r[c] for c in key) for r in again.filter("contact = 1").collect()} == first
    detail = spark.read.parquet(str(tmp_path / "again" / "detail"))
    assert sorted(r["rank_desc"] for r in detail.collect()) == list(range(1, again.count() + 1))


def test_search_refit_and_store(spark, tmp_path):
    rows = [(i, 1 + i % 2, (i * 37) % 100 / 10.0, (i * 53) % 17, int((i * 37) % 100 > 70)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, period int, signal double, other int, y int")
    df = df.select("*", F.lit(1.0).alias("w"), F.col("y").alias("hit"))
    spec = PanelSpec("id", "period", "y")
    matrix = training.train_matrix(df, spec, [1, 2], "y", "w", "hit")
    space = {"stepSize": ("log", 0.05, 0.2), "minInstancesPerNode": ("int", 2, 5)}
    manifest = stages.search_stage(matrix, spec, str(tmp_path / "m"), [1], folds=2, trials=2, space=space, **FAST)
    models, again = training.load_ensemble(str(tmp_path / "m"))
    assert again == manifest and len(models) == 1
    assert len(models[0].stages[-1].trees) == manifest.metrics["best_round"] == manifest.params["maxIter"]
    assert manifest.metrics["cv_profit"] > 0


def test_step_generations_agree(spark, raw):
    panel = spark.read.parquet(raw)
    steps, sql = stages.build_features(panel, generation="steps"), stages.build_features(panel, generation="sql")
    assert set(steps.columns) == set(sql.columns)
    rounded = [
        F.round(c, 6).alias(c) if t in ("double", "float") else F.col(c).cast("string").alias(c)
        for c, t in steps.dtypes
    ]
    assert steps.select(rounded).exceptAll(sql.select(rounded)).count() == 0
    with pytest.raises(ValueError):
        stages.build_features(panel, generation="none")


def test_quality_report(spark, raw):
    report = stages.quality_report(spark.read.parquet(raw))
    periods = [202101 + m for m in range(8)]
    assert sorted(r["foto_mes"] for r in report.drift.collect()) == periods
    assert sorted(r["foto_mes"] for r in report.outliers.collect()) == periods
    assert report.to_drop.columns == ["foto_mes"]


def test_label_stage_by_join(spark, raw, tmp_path):
    a, b = str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")
    spec = PanelSpec("numero_de_cliente", "foto_mes", "clase_ternaria")
    stages.label_stage(spark, raw, a, spec)
    stages.label_stage(spark, raw, b, spec, unique_key=False)
    left, right = spark.read.parquet(a), spark.read.parquet(b)
    assert left.select(sorted(left.columns)).exceptAll(right.select(sorted(left.columns))).count() == 0
