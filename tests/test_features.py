import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.operators import features, group_features
from tidemark.spec import BANK_PANEL, PanelSpec

COLUMNS = (
    "id long, period int, sa double, sb double, ca long, cb long, la double, lb double, "
    "ba double, bb double, sent double, received double, nsent long, ncash long, act long, ten long"
)
SPEC = PanelSpec(
    "id", "period", "target",
    roles={
        "spend_a": "sa", "spend_b": "sb", "count_a": "ca", "count_b": "cb", "limit_a": "la",
        "limit_b": "lb", "balance_a": "ba", "balance_b": "bb", "sent_amount": "sent",
        "received_amount": "received", "sent_count": "nsent", "cash_count": "ncash",
        "activity": "act", "tenure": "ten",
    },
)
ROWS = [
    # a month is missing between the second and the third row
    (1, 202101, 100.0, None, 2, None, 1000.0, 500.0, 50.0, None, 10.0, 200.0, 1, 3, 10, 30),
    (1, 202102, None, 300.0, None, 3, None, 300.0, None, 296.0, 0.0, None, 0, 1, 4, 31),
    (1, 202104, 50.0, 50.0, 1, 1, 0.0, None, 1.0, 1.0, None, 0.0, None, None, 2, 33),
    (1, 202105, 0.0, 0.0, 0, 0, 10.0, 0.0, 0.0, 0.0, 5.0, 90.0, 0, 0, 1, 34),
    (2, 202101, None, None, None, None, None, None, None, None, None, None, None, None, 8, None),
]


@pytest.fixture(scope="module")
def full(spark):
    panel = spark.createDataFrame(ROWS, COLUMNS)
    df = features.features_full(panel, SPEC).cache()
    return {(r["id"], r["period"]): r.asDict() for r in df.collect()}


def test_sums_treat_null_as_zero(full):
    row = full[1, 202101]
    assert (row["spend_total"], row["count_total"], row["limit_total"]) == (100.0, 2, 1500.0)
    assert row["tx_count"] == 2 + 0 + 1 + 3
    assert row["tx_amount"] == 100.0 + 10.0 + 200.0
    assert str(row["period_date"]) == "2021-01-01"
    empty = full[2, 202101]
    assert (empty["spend_total"], empty["tx_count"], empty["tx_amount"]) == (0, 0, 0)


def test_lags_count_rows_not_months(full):
    assert full[1, 202101]["spend_lag1"] is None
    assert full[1, 202104]["spend_lag1"] == 300.0
    assert full[1, 202104]["spend_delta1"] == -200.0
    assert full[1, 202104]["activity_lag2"] == 10
    assert full[1, 202105]["activity_lag3"] == 10
    assert full[1, 202104]["history_index"] == 3
    # single brands keep their NULLs
    assert full[1, 202102]["spend_a_lag1"] == 100.0 and full[1, 202102]["spend_a_delta1"] is None


def test_rolling_and_running(full):
    row = full[1, 202104]
    assert row["spend_avg1"] == 100.0 and row["spend_avg2"] == 200.0
    assert row["spend_avg3"] == pytest.approx(500 / 3)
    assert row["spend_to_date"] == 500.0 and row["count_to_date"] == 7
    assert row["tx_amount_min3"] == 100.0 and row["tx_amount_max3"] == 310.0
    # four rows, although the names of such windows often say three
    assert full[1, 202105]["activity_avg4"] == pytest.approx((10 + 4 + 2 + 1) / 4)
    assert full[1, 202105]["activity_max4"] == 10 and full[1, 202105]["activity_min4"] == 1


def test_ratios_and_guards(full):
    assert full[1, 202101]["utilisation"] == pytest.approx(100 / 1500)
    assert full[1, 202104]["utilisation"] == 0.0
    assert full[1, 202105]["mean_ticket"] is None
    assert full[1, 202102]["spend_growth"] == pytest.approx(2.0)
    assert full[2, 202101]["spend_growth"] is None
    assert full[1, 202102]["received_per_sent"] is None
    assert full[1, 202101]["received_per_sent"] == 20.0
    assert full[2, 202101]["activity_per_tenure"] is None


def test_trend(full):
    assert full[1, 202101]["spend_slope"] is None
    assert full[1, 202102]["spend_slope"] == pytest.approx(200.0)
    assert full[1, 202102]["spend_intercept"] == pytest.approx(-100.0)
    assert full[1, 202104]["spend_slope"] == pytest.approx(0.0, abs=1e-9)


def test_risk_flags(full):
    assert full[1, 202101]["flag_activity_drop"] == 0
    assert full[1, 202102]["flag_activity_drop"] == 1
    assert full[1, 202104]["flag_two_periods_down"] == 1
    assert full[1, 202104]["flag_near_inactive"] == 1
    assert full[1, 202105]["flag_near_inactive"] == 0
    assert full[1, 202104]["flag_old_low_use"] == 1
    assert full[1, 202102]["flag_high_utilisation"] == 1
    assert full[1, 202104]["received_delta1"] is None
    assert full[1, 202102]["flag_income_drop"] == 0
    assert full[1, 202105]["activity_drop_share"] == pytest.approx(-0.5)


def test_behaviour(full):
    row = full[1, 202105]
    assert row["low_activity_count3"] == 2 and row["flag_long_inactive"] == 0
    assert full[1, 202104]["no_income_count3"] == 2
    assert row["activity_max_to_date"] == 10 and row["activity_vs_best"] == 0.1
    assert full[1, 202101]["activity_std3"] is None and full[1, 202101]["activity_cv3"] is None
    assert full[1, 202102]["activity_std3"] == pytest.approx(math.sqrt(18))
    assert full[1, 202102]["flag_credit_maxed"] == 1
    assert full[1, 202102]["total_before"] == 100.0 and full[1, 202102]["total_change"] == 300.0
    assert full[1, 202104]["flag_veteran_idle"] == 1
    assert full[2, 202101]["flag_recent"] == 0


def test_tenure_ranking_puts_null_last(full):
    assert full[1, 202101]["tenure_row"] == 1 and full[2, 202101]["tenure_row"] == 2
    assert full[2, 202101]["tenure_percent_rank"] == 1.0
    assert full[1, 202101]["tenure_cume_dist"] == 0.5
    assert full[1, 202104]["tenure_percent_rank"] == 0.0
    assert full[2, 202101]["tenure_quartile"] == 2


def test_one_exchange_per_entity_after_the_ranking(spark):
    panel = spark.createDataFrame(ROWS, COLUMNS)
    df = features.card_features(panel, SPEC)
    for step in (
        features.activity_features, features.rolling_activity_stats, features.risk_features,
        features.behaviour_features,
    ):
        df = step(df, SPEC)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort") == 1


def test_attach_refuses_or_renames_clashes(spark):
    left = spark.createDataFrame([(1, 202101, 5)], "id long, period int, x int")
    right = spark.createDataFrame([(1, 202101, 6)], "id long, period long, x int")
    with pytest.raises(ValueError):
        features.attach(left, right, SPEC, ["x"])
    row = features.attach(left, right, SPEC, ["x"], suffix="_right").first()
    assert (row["x"], row["x_right"]) == (5, 6)


def test_group_sums_skip_absent_columns(spark):
    df = spark.createDataFrame([(1, 202101, 5.0, None)], "id long, period int, mpayroll double, cseguro_vida int")
    summed = group_features.group_sums(df)
    row = summed.first()
    assert row["m_payroll_total"] == 5.0 and row["c_seguros_total"] == 0
    assert row["m_inversiones_pesos"] == 0
    assert len(fixed.BANK_GROUPS) == 13 and len(group_features.smoothed_groups()) == 12


def _history(spark, values):
    rows = [(1, 201901 + i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, period int, x double")


def test_ema_and_extremes(spark):
    values = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8]
    df = group_features.smoothing_and_extremes(_history(spark, values), SPEC, ["x", "absent"])
    rows = df.orderBy("period").collect()
    for t, row in enumerate(rows):
        for alpha, name in ((0.3, "x_ema_alpha0p3"), (0.6, "x_ema_alpha0p6")):
            w = [(1 - alpha) ** (t - i) for i in range(t + 1)]
            expected = sum(a * b for a, b in zip(w, values)) / sum(w)
            assert row[name] == pytest.approx(expected, rel=1e-12)
        for n in (3, 6, 12):
            seen = values[max(0, t - n + 1) : t + 1]
            assert row[f"x_max_win{n}"] == max(seen) and row[f"x_min_win{n}"] == min(seen)


def test_ema_of_long_history(spark):
    n = 3000
    df = spark.range(n).select(
        F.lit(1).alias("id"), F.col("id").cast("int").alias("period"), F.lit(2.5).alias("x")
    )
    averaged = group_features.with_ema(df, SPEC, ["x"], [0.6]).withColumnRenamed("x_ema_alpha0p6", "e")
    out = averaged.agg(F.min("e"), F.max("e")).first()
    assert out[0] == pytest.approx(2.5) and out[1] == pytest.approx(2.5)


def test_ema_over_segments_equals_the_recursion(spark):
    """Several segments, gaps at the start, at a border and in the middle, and a second entity."""
    n, alphas = 2000, (0.3, 0.6, 1.0)
    rows = [(i, t, None if t < 3 or t % 7 == 2 or 140 < t < 160 else math.sin(t) * 10 ** (t % 5) + i) for i in (1, 2) for t in range(n if i == 1 else 5)]
    df = spark.createDataFrame(rows, "id long, period int, x double")
    got = {(r["id"], r["period"]): r for r in group_features.with_ema(df, SPEC, ["x"], alphas).collect()}
    assert group_features._segment_rows(alphas) < n / 10
    for alpha in alphas:
        top, bottom = {1: 0.0, 2: 0.0}, {1: 0.0, 2: 0.0}
        for i, t, x in rows:
            top[i] = top[i] * (1 - alpha) + (0.0 if x is None else x)
            bottom[i] = bottom[i] * (1 - alpha) + (x is not None)
            expected = top[i] / bottom[i] if bottom[i] else None
            value = got[i, t][group_features.ema_name("x", alpha)]
            assert value is None if expected is None else value == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_lag_candidates_and_late_filter(spark):
    df = spark.createDataFrame(
        [(1, p, "CONTINUA", float(i), 2.0 * i) for i, p in enumerate((201905, 201906, 201907, 201908))],
        "id long, period int, target string, mpayroll double, other double",
    )
    groups = {"pay": ["mpayroll"]}
    v2 = group_features.features_v2(df, SPEC, groups)
    assert {"pay_lag1", "pay_d2", "other_lag2"} <= set(v2.columns)
    assert not any(c.startswith(("id_", "period_", "target_")) for c in v2.columns)
    v3 = group_features.features_v3(df, SPEC, groups, ())
    rows = {r["period"]: r for r in v3.collect()}
    assert set(rows) == {201907, 201908}
    assert rows[201907]["other_lag2"] == 0.0 and rows[201907]["pay_max_win3"] == 2.0
    assert not any("_ema_" in c and c.endswith("_lag1") for c in v3.columns)


def test_bank_panel_names_every_role():
    assert set(BANK_PANEL.roles) == set(fixed.BANK_ROLES)
    with pytest.raises(KeyError):
        PanelSpec("a", "b").role("spend_a")
