import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation, scoring
from tidemark.spec import PanelSpec

SPEC = PanelSpec("id", "period", "target")


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(1, 202104, 0.9, 1), (2, 202104, 0.9, 0), (3, 202104, 0.1, 1), (4, 202104, 0.1, 0)]
    return spark.createDataFrame(rows, "id long, period int, score double, hit int")


def test_scored_table(scores):
    rows = {r["id"]: r for r in scoring.scored_table(scores, SPEC, 0.5).collect()}
    assert [rows[i]["contact"] for i in (1, 2, 3, 4)] == [1, 1, 0, 0]
    assert [rows[i]["rank_desc"] for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
    export = scoring.simple_export(scoring.scored_table(scores, SPEC, 0.5), SPEC)
    assert export.columns == ["id", "Predicted"]


def test_mean_score_is_clipped(spark):
    row = spark.range(1).select(
        scoring.mean_score([F.lit(0.4), F.lit(0.8)]).alias("m"),
        scoring.mean_score([F.lit(1.0), F.lit(1.0)]).alias("one"),
        scoring.clip_probability(F.lit(None).cast("double")).alias("none"),
    ).first()
    assert row["m"] == pytest.approx(0.6)
    assert row["one"] == 1 - 1e-15 and row["none"] is None


@pytest.mark.parametrize("n", [0, 1, 3, 4, 50])
def test_top_n(scores, n):
    rows = scoring.top_n_flag(scores, SPEC, n).collect()
    assert {r["id"] for r in rows if r["contact"] == 1} == set(range(1, min(n, 4) + 1))
    assert len(rows) == 4


def test_head_report_and_sort(scores):
    assert [r["id"] for r in scoring.head_report(scores, SPEC, 3).collect()] == [1, 2, 3]
    assert [r["id"] for r in scoring.sort_scores(scores, SPEC).collect()] == [1, 2, 3, 4]


def _peak(curve):
    return evaluation.profit_peak(curve).first().asDict()


def test_profit_curve(scores):
    curve = evaluation.profit_curve(scores, "score", "hit", "id")
    rows = {r["contacts"]: r["profit"] for r in curve.collect()}
    assert rows == {1: 780_000, 2: 760_000, 3: 1_540_000, 4: 1_520_000}
    assert _peak(curve) == {"max_profit": 1_540_000, "best_contacts": 3}


def test_profit_may_be_negative_and_takes_the_first_peak(spark):
    rows = [(i, 202104, 1.0 / i, 0) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "id long, period int, score double, hit int")
    assert _peak(evaluation.profit_curve(df, "score", "hit", "id")) == {
        "max_profit": -20_000, "best_contacts": 1,
    }
    flat = evaluation.profit_curve(df, "score", "hit", "id", cost=0)
    assert _peak(flat) == {"max_profit": 0, "best_contacts": 1}


def test_profit_curve_per_group_with_many_ties(spark):
    df = spark.range(3000).select(
        "id",
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 2 == 0, 0.5).otherwise((F.col("id") * 7919 % 1000) / 1000.0).alias("score"),
        (F.col("id") % 11 == 0).cast("int").alias("hit"),
    ).cache()
    curve = evaluation.profit_curve(df, "score", "hit", "id", ["g"], slices=30)
    got = {r["g"]: (r["max_profit"], r["best_contacts"]) for r in evaluation.profit_peak(curve, ["g"]).collect()}
    for g in range(3):
        rows = sorted((r for r in df.collect() if r["g"] == g), key=lambda r: (-r["score"], r["id"]))
        total, best, at = 0, None, None
        for i, r in enumerate(rows, 1):
            total += 780_000 if r["hit"] else -20_000
            if best is None or total > best:
                best, at = total, i
        assert got[g] == (best, at)


def test_rows_without_a_score_come_last(spark):
    rows = [(1, 202101, 0.9, 1), (2, 202101, 0.8, 0), (3, 202101, None, 1), (4, 202101, float("nan"), 1), (5, 202101, 0.1, 0)]
    df = spark.createDataFrame(rows, f"{SPEC.id} long, {SPEC.period} int, score double, hit int")
    flagged = scoring.top_n_flag(df, SPEC, 2).collect()
    assert {r[SPEC.id] for r in flagged if r["contact"] == 1} == {1, 2}
    assert [r[SPEC.id] for r in scoring.sort_scores(df, SPEC).collect()][:3] == [1, 2, 5]
    assert tuple(evaluation.profit_top_n(df, "score", "hit", SPEC.id, 1).first()) == (1, 780_000)
    assert tuple(evaluation.profit_top_n(df, "score", "hit", SPEC.id, 3).first()) == (3, 740_000)


def test_profit_top_n(scores):
    for n, expected in ((1, (1, 780_000)), (2, (2, 760_000)), (9, (4, 1_520_000))):
        assert tuple(evaluation.profit_top_n(scores, "score", "hit", "id", n).first()) == expected


def test_threshold_profit(scores):
    flagged = scores.withColumn("contact", scoring.threshold_flag(F.col("score"), 0.5))
    assert evaluation.profit_at_threshold(flagged, "contact", "hit").first()[0] == 760_000
    assert evaluation.profit_at_threshold(flagged, "contact", None).first()[0] == -40_000
    assert evaluation.profit_at_threshold(flagged, "contact", "absent", no_truth_is_zero=True).first()[0] == 0
    assert evaluation.profit_at_threshold(flagged.limit(0), "contact", "hit").first()[0] == 0


def test_confusion_matrix_has_empty_cells(scores):
    flagged = scores.withColumn("contact", F.lit(1))
    cells = {(r["actual"], r["predicted"]): r["n"] for r in evaluation.confusion_matrix(flagged, "contact", "hit").collect()}
    assert cells == {(0, 0): 0, (0, 1): 2, (1, 0): 0, (1, 1): 2}


def test_log_loss(scores):
    p, y = [0.9, 0.9, 0.1, 0.1], [1, 0, 1, 0]
    expected = -sum(a * math.log(b) + (1 - a) * math.log(1 - b) for a, b in zip(y, p)) / 4
    assert evaluation.log_loss(scores, "score", "hit").first()[0] == pytest.approx(expected)


def test_coverage(scores):
    flagged = scores.withColumn("contact", scoring.threshold_flag(F.col("score"), 0.5))
    assert tuple(evaluation.coverage(flagged, "contact").first()) == (2, 4, 50.0)
    assert tuple(evaluation.coverage(flagged.limit(0), "contact").first()) == (0, 0, 0.0)


def test_truth_joins(spark, scores):
    truth = spark.createDataFrame([(1, 202104, 1), (9, 202104, 1)], "id long, period int, hit int")
    predictions = scores.drop("hit")
    joined = {r["id"]: r["hit"] for r in evaluation.with_truth(predictions, truth, SPEC, "hit").collect()}
    assert joined == {1: 1, 2: 0, 3: 0, 4: 0}
    assert not evaluation.truth_is_missing(truth, predictions, SPEC, "hit")
    assert evaluation.truth_is_missing(truth.filter("id = 9"), predictions, SPEC, "hit")
    flags = predictions.select("id", F.lit(1).alias("contact"))
    assert evaluation.join_truth_by_id(truth, flags, SPEC, "hit", "contact").count() == 1
