import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.periods import period_add, period_date, yyyymm_add
from tidemark.operators import labels
from tidemark.spec import PanelSpec

SPEC = PanelSpec("id", "period", "target")
DAYS = PanelSpec("id", "period", "target", granularity="index")


def _months(spark, values, k):
    df = spark.createDataFrame([(v,) for v in values], "p int")
    return [r[0] for r in df.select(yyyymm_add("p", k)).collect()]


def test_month_arithmetic(spark):
    assert _months(spark, [199906, 199911, 199912], 3) == [199909, 200002, 200003]
    assert _months(spark, [200001], -1) == [199912]
    assert _months(spark, [200001], -25) == [199712]
    assert _months(spark, [200405], 20) == [200601]


def test_month_arithmetic_inverts(spark):
    all_months = [y * 100 + m for y in range(1999, 2003) for m in range(1, 13)]
    for k in (1, 5, 12, 30):
        moved = _months(spark, all_months, k)
        assert _months(spark, moved, -k) == all_months
        assert moved == sorted(moved) and all(1 <= p % 100 <= 12 for p in moved)


def test_period_date_and_unknown_granularity(spark):
    row = spark.range(1).select(period_date(F.lit(202104)).alias("d")).first()
    assert str(row["d"]) == "2021-04-01"
    with pytest.raises(ValueError):
        period_add("p", 1, "week")


def _panel(spark, rows):
    return spark.createDataFrame(rows, "id long, period int")


def _by_key(df):
    return {(r["id"], r["period"]): r["target"] for r in df.collect()}


def test_label_of_small_panel(spark):
    """One customer over a year's end, one who leaves two months before the last one."""
    panel = _panel(spark, [(7, 202311), (7, 202312), (7, 202401), (7, 202402), (9, 202311), (9, 202312)])
    expected = {
        (7, 202311): "CONTINUA",
        (7, 202312): "CONTINUA",
        (7, 202401): "BAJA+2",
        (7, 202402): "BAJA+1",
        (9, 202311): "BAJA+2",
        (9, 202312): "BAJA+1",
    }
    assert _by_key(labels.attrition_label(panel, SPEC)) == expected
    assert _by_key(labels.label_by_join(panel, SPEC)) == expected


def test_label_with_gaps_and_year_roll_over(spark):
    # present at t+2 but not at t+1 is still gone next month
    panel = _panel(spark, [(1, 202111), (1, 202201), (1, 202202), (1, 202203)])
    got = _by_key(labels.attrition_label(panel, SPEC))
    assert got[1, 202111] == "BAJA+1"
    assert got[1, 202201] == "CONTINUA"


@pytest.mark.parametrize("spec", [SPEC, DAYS])
def test_window_and_join_agree_with_brute_force(spark, spec):
    rng = random.Random(7)
    if spec is SPEC:
        periods = [y * 100 + m for y in (2020, 2021) for m in range(1, 13)]
    else:
        periods = list(range(100, 124))
    present = {(i, p) for i in range(40) for p in periods if rng.random() < 0.7}
    panel = _panel(spark, sorted(present))
    after = dict(zip(periods, periods[1:] + [None]))
    expected = {}
    for i, p in present:
        one = after[p]
        two = after.get(one)
        if (i, one) not in present:
            expected[i, p] = "BAJA+1"
        elif (i, two) not in present:
            expected[i, p] = "BAJA+2"
        else:
            expected[i, p] = "CONTINUA"
    assert _by_key(labels.attrition_label(panel, spec)) == expected
    assert _by_key(labels.label_by_join(panel, spec)) == expected


def test_join_form_does_not_multiply_duplicates(spark):
    panel = _panel(spark, [(1, 202101), (1, 202101), (1, 202102)])
    assert labels.label_by_join(panel, SPEC).count() == 3


def test_targets_and_weights(spark):
    df = spark.createDataFrame(
        [("BAJA+1",), ("BAJA+2",), ("CONTINUA",), (None,), ("other",)], "target string"
    )
    df = labels.class_weights(labels.binary_targets(df, "target"), "target")
    rows = {r["target"]: r for r in df.collect()}
    assert [rows[k]["is_gone_in_two"] for k in ("BAJA+1", "BAJA+2", "CONTINUA", None)] == [0, 1, 0, 0]
    assert [rows[k]["is_leaver"] for k in ("BAJA+1", "BAJA+2", "CONTINUA", None)] == [1, 1, 0, 1]
    assert rows["BAJA+2"]["row_weight"] == 1.00002
    assert rows["BAJA+1"]["row_weight"] == 1.00001
    assert rows[None]["row_weight"] == rows["other"]["row_weight"] == 1.0
    with pytest.raises(KeyError):
        labels.binary_targets(df, "absent")


def test_existing_targets_and_weights_are_kept_on_request(spark):
    df = spark.createDataFrame([("BAJA+2", 9, 5.0)], "target string, is_leaver int, row_weight double")
    kept = labels.binary_targets(df, "target", only_missing=True).first()
    assert kept["is_leaver"] == 9 and kept["is_gone_in_two"] == 1
    assert labels.class_weights(df, "target", only_missing=True).first()["row_weight"] == 5.0
    assert labels.default_weight(df).first()["row_weight"] == 5.0
    assert labels.default_weight(df.drop("row_weight")).first()["row_weight"] == 1.0
