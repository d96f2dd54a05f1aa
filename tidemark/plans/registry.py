"""Named queries: one per operator, each over whole tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.periods import period_date, yyyymm_add
from ..functions.scalars import logistic
from ..operators import boosting, drift, evaluation, features, group_features, labels, sampling, scoring
from ..operators import selection, sketches, training
from ..operators.ranking import rank_rows
from ..sources import monthly
from ..sources.panels import append_snapshot, original_names, standard_names
from ..sources.staging import stage, staging_dir
from . import panels, sql_steps
from .compare import comparable
from .panels import CUSTOMER_MONTH, MEASURES, SUPPLIER_MONTH, USER_DAY, USER_MEASURES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORED_DAY = 19737  # 2024-01-15
FUTURE_DAYS = 3
FIRST_PERIOD = 199607
TOP_N = 500
MODEL_FEATURES = ["events", "value_sum", "value_max", "n_error", "never_seen", "n_purchase"]


def query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(f(spark, sf_dir))

    QUERIES[f.__name__] = run
    return run


# -- panels ---------------------------------------------------------------------------------


@query
def panel_customer_month(spark, sf_dir):
    return panels.customer_month(spark, sf_dir)


@query
def panel_supplier_month(spark, sf_dir):
    return panels.supplier_month(spark, sf_dir)


@query
def panel_user_day(spark, sf_dir):
    return panels.user_day(spark, sf_dir)


# -- labels ---------------------------------------------------------------------------------


def _labelled_days(spark, sf_dir):
    return labels.attrition_label(panels.user_day(spark, sf_dir), USER_DAY)


@query
def attrition_label(spark, sf_dir):
    df = labels.attrition_label(panels.customer_month(spark, sf_dir), CUSTOMER_MONTH)
    return df.select("customer_id", "period", "activity", "target")


@query
def label_by_join(spark, sf_dir):
    panel = panels.customer_month(spark, sf_dir).select("customer_id", "period", "activity")
    df = labels.label_by_join(stage(panel), CUSTOMER_MONTH)
    return df.select("customer_id", "period", "activity", "target")


@query
def attrition_label_days(spark, sf_dir):
    return _labelled_days(spark, sf_dir).select("user_id", "period", "events", "target")


@query
def targets_and_weights(spark, sf_dir):
    df = labels.binary_targets(_labelled_days(spark, sf_dir), "target")
    df = labels.default_weight(labels.class_weights(df, "target"), "unit_weight")
    return df.select(
        "user_id", "period", "target", "is_gone_in_two", "is_leaver", "row_weight", "unit_weight"
    )


@query
def period_arithmetic(spark, sf_dir):
    df = standard_names(panels.customer_month(spark, sf_dir), CUSTOMER_MONTH).select(
        "entity_id",
        "period",
        yyyymm_add("period", 1).alias("next_period"),
        yyyymm_add("period", 2).alias("second_period"),
        yyyymm_add("period", -13).alias("year_ago"),
        period_date("period").alias("period_date"),
    )
    return original_names(df, CUSTOMER_MONTH)


# -- the five feature steps -----------------------------------------------------------------


@query
def base_combos(spark, sf_dir):
    return features.base_combos(panels.customer_month(spark, sf_dir), CUSTOMER_MONTH)


@query
def sequence_features(spark, sf_dir):
    combos = features.base_combos(panels.customer_month(spark, sf_dir), CUSTOMER_MONTH)
    return features.sequence_features(combos, CUSTOMER_MONTH).drop(*MEASURES)


@query
def numeric_summary(spark, sf_dir):
    combos = features.base_combos(panels.customer_month(spark, sf_dir), CUSTOMER_MONTH)
    return features.numeric_summary(
        combos.select("*", CUSTOMER_MONTH.history.index().alias("history_index")), CUSTOMER_MONTH
    )


@query
def trend_features(spark, sf_dir):
    combos = features.base_combos(panels.customer_month(spark, sf_dir), CUSTOMER_MONTH)
    return features.trend_features(combos, CUSTOMER_MONTH).select(
        "customer_id", "period", "spend_slope", "spend_intercept"
    )


@query
def trend_features_supplier(spark, sf_dir):
    combos = features.base_combos(panels.supplier_month(spark, sf_dir), SUPPLIER_MONTH)
    return features.trend_features(combos, SUPPLIER_MONTH).select(
        "supplier_id", "period", "spend_slope", "spend_intercept"
    )


@query
def activity_rank_features(spark, sf_dir):
    panel = stage(panels.supplier_month(spark, sf_dir))
    return features.activity_rank_features(panel, SUPPLIER_MONTH)


@query
def rolling_stats_joined(spark, sf_dir):
    panel = stage(panels.supplier_month(spark, sf_dir))
    return features.rolling_stats_joined(panel, SUPPLIER_MONTH)


@query
def risk_features(spark, sf_dir):
    spec = CUSTOMER_MONTH
    df = features.card_features(panels.customer_month(spark, sf_dir), spec)
    df = features.risk_features(features.activity_features(df, spec), spec)
    return df.select(*spec.key, *features.RISK_COLUMNS)


@query
def risk_joined_back(spark, sf_dir):
    """Risk features as a table of their own, joined back; carried columns get a suffix."""
    spec = CUSTOMER_MONTH
    panel = panels.customer_month(spark, sf_dir)
    base = stage(features.activity_features(features.card_features(panel, spec), spec))
    carried = ["received_amount", "sent_amount", "utilisation"]
    risk = features.risk_features(base, spec)
    joined = features.attach(base, risk, spec, [*features.RISK_COLUMNS, *carried], suffix="_risk")
    return joined.select(
        *spec.key, "tx_amount", *carried, *features.RISK_COLUMNS, *[f"{c}_risk" for c in carried]
    )


@query
def behaviour_features(spark, sf_dir):
    spec = CUSTOMER_MONTH
    before = features.activity_features(
        features.card_features(panels.customer_month(spark, sf_dir), spec), spec
    )
    df = features.behaviour_features(before, spec)
    return df.select(*spec.key, *[c for c in df.columns if c not in before.columns])


@query
def features_full(spark, sf_dir):
    panel = stage(panels.customer_month(spark, sf_dir))
    return features.features_full(panel, CUSTOMER_MONTH)


@query
def features_full_sql(spark, sf_dir):
    panel = stage(panels.customer_month(spark, sf_dir))
    return sql_steps.run_standard_steps(panel, CUSTOMER_MONTH)


# -- generated features ---------------------------------------------------------------------


@query
def group_sums(spark, sf_dir):
    df = group_features.group_sums(panels.supplier_month(spark, sf_dir), panels.GROUPS)
    return df.select(*SUPPLIER_MONTH.key, *panels.GROUPS)


@query
def lags_deltas_all(spark, sf_dir):
    df = group_features.lags_and_deltas(panels.supplier_month(spark, sf_dir), SUPPLIER_MONTH)
    return df.drop(*MEASURES)


def _smoothed(spark, sf_dir):
    df = group_features.group_sums(panels.supplier_month(spark, sf_dir), panels.GROUPS)
    chosen = group_features.smoothed_groups(panels.GROUPS, panels.GROUPS_NOT_SMOOTHED)
    return group_features.smoothing_and_extremes(df, SUPPLIER_MONTH, chosen)


@query
def ema(spark, sf_dir):
    df = _smoothed(spark, sf_dir)
    return df.select(*SUPPLIER_MONTH.key, *[c for c in df.columns if "_ema_" in c])


@query
def rolling_max_min(spark, sf_dir):
    df = _smoothed(spark, sf_dir)
    return df.select(*SUPPLIER_MONTH.key, *[c for c in df.columns if "_win" in c])


@query
def features_v2(spark, sf_dir):
    return group_features.features_v2(
        panels.supplier_month(spark, sf_dir), SUPPLIER_MONTH, panels.GROUPS
    )


@query
def features_v3(spark, sf_dir):
    return group_features.features_v3(
        panels.supplier_month(spark, sf_dir), SUPPLIER_MONTH, panels.GROUPS,
        panels.GROUPS_NOT_SMOOTHED, FIRST_PERIOD,
    )


# -- drift and outliers ---------------------------------------------------------------------


def _report_panel(spark, sf_dir):
    return stage(panels.supplier_month(spark, sf_dir).select(*SUPPLIER_MONTH.key, *MEASURES))


def _psi(panel):
    return drift.psi_by_column_period(panel, "period", MEASURES)


def _rates(panel):
    return drift.outlier_rate_by_column_period(panel, "period", MEASURES)


@query
def psi_cuts(spark, sf_dir):
    panel = _report_panel(spark, sf_dir)
    base = selection.filter_periods(panel, "period", drift.baseline_periods(panel, "period"))
    cuts = drift.psi_cuts(base, MEASURES)
    rows = [(c, i + 1, v) for c, values in cuts.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "column string, position int, cut double")


@query
def iqr_bounds(spark, sf_dir):
    bounds = drift.iqr_bounds(_report_panel(spark, sf_dir), MEASURES)
    rows = [(c, *limits) for c, limits in bounds.items() if limits]
    return spark.createDataFrame(rows, "column string, low double, high double")


@query
def psi_by_column_month(spark, sf_dir):
    return _psi(_report_panel(spark, sf_dir))


@query
def psi_of_wide_panel(spark, sf_dir):
    """PSI of 154 columns: the measures, their lags and deltas."""
    panel = panels.supplier_month(spark, sf_dir).select(*SUPPLIER_MONTH.key, *MEASURES)
    wide = group_features.lags_and_deltas(panel, SUPPLIER_MONTH, MEASURES, panels.WIDE_STEPS)
    columns = [c for c in wide.columns if c not in SUPPLIER_MONTH.key]
    return drift.psi_by_column_period(stage(wide), "period", columns)


@query
def drift_by_month(spark, sf_dir):
    report = drift.drift_by_period(_psi(_report_panel(spark, sf_dir)), "period", len(MEASURES))
    return report.select("*", period_date("period").alias("period_date"))


@query
def outlier_rate_by_column_month(spark, sf_dir):
    return _rates(_report_panel(spark, sf_dir))


@query
def outlier_by_month(spark, sf_dir):
    report = drift.outlier_by_period(_rates(_report_panel(spark, sf_dir)), "period", len(MEASURES))
    return report.select("*", period_date("period").alias("period_date"))


def _bad_months(panel):
    return drift.periods_to_drop(
        drift.drift_by_period(_psi(panel), "period", len(MEASURES)),
        drift.outlier_by_period(_rates(panel), "period", len(MEASURES)),
        "period",
    )


@query
def months_to_drop(spark, sf_dir):
    return _bad_months(_report_panel(spark, sf_dir))


@query
def panel_without_bad_months(spark, sf_dir):
    panel = _report_panel(spark, sf_dir)
    return drift.without_periods(panel, _bad_months(panel), "period")


# -- periods, samples, folds ----------------------------------------------------------------


@query
def distinct_months(spark, sf_dir):
    return panels.customer_month(spark, sf_dir).select("period").distinct().orderBy("period")


@query
def append_snapshot_month(spark, sf_dir):
    panel = stage(panels.customer_month(spark, sf_dir))
    last = selection.distinct_periods(panel, "period")[-1]
    return append_snapshot(
        panel.filter(F.col("period") < last), panel.filter(F.col("period") == last)
    )


@query
def train_future_split(spark, sf_dir):
    days = stage(_labelled_days(spark, sf_dir).select("user_id", "period", "events", "target"))
    available = selection.distinct_periods(days, "period")
    periods = selection.resolve_periods(available, future=available[-FUTURE_DAYS:])
    train, future = selection.train_future_split(days, "period", periods)
    return train.select("*", F.lit("train").alias("part")).unionByName(
        future.select("*", F.lit("future").alias("part"))
    )


@query
def undersample_majority(spark, sf_dir):
    panel = panels.supplier_month(spark, sf_dir).select(*SUPPLIER_MONTH.key, "activity", "spend_f")
    labelled = labels.attrition_label(panel, SUPPLIER_MONTH)
    return sampling.undersample_majority(stage(labelled), SUPPLIER_MONTH)


@query
def filter_class(spark, sf_dir):
    days = _labelled_days(spark, sf_dir).select("user_id", "period", "events", "target")
    return selection.filter_class(days, "target", fixed.STAYS, equal=False)


@query
def stratified_folds(spark, sf_dir):
    df = labels.binary_targets(_labelled_days(spark, sf_dir), "target")
    df = stage(df.select("user_id", "period", "is_leaver"))
    return sampling.stratified_folds(df, USER_DAY, "is_leaver")


@query
def folds_missing_label(spark, sf_dir):
    """Folds where a fifth of the rows has no label."""
    df = labels.binary_targets(_labelled_days(spark, sf_dir), "target")
    label = F.when(F.col("user_id") % 5 != 0, F.col("is_leaver"))
    df = stage(df.select("user_id", "period", label.alias("is_leaver")))
    return sampling.stratified_folds(df, USER_DAY, "is_leaver")


@query
def canary_columns(spark, sf_dir):
    return sampling.canary_columns(_labelled_days(spark, sf_dir), USER_DAY)


@query
def aligned_matrix(spark, sf_dir):
    df = selection.drop_if_exists(
        _labelled_days(spark, sf_dir), [*fixed.LEAK_COLUMNS, *fixed.CANARY_BLOCK_COLUMNS, "n_view"]
    )
    numeric = selection.model_columns(df, USER_DAY.key)
    matrix = df.select(*USER_DAY.key, *numeric)
    return selection.align_features(matrix, MODEL_FEATURES, keep=USER_DAY.key)


# -- scoring and evaluation with closed-form scores -----------------------------------------


def _model_scores():
    return [
        F.round(logistic(0.8 * F.col("n_error") - 0.3 * F.col("n_purchase") - 1.0), 6),
        F.round(logistic(0.01 * F.col("value_sum") - 2.0), 6),
        F.round(logistic(0.02 * F.col("value_max") - 0.5 * F.col("events")), 6),
    ]


def _scored_days(spark, sf_dir, period=None):
    """Targets and the mean score of three fixed models."""
    df = labels.binary_targets(_labelled_days(spark, sf_dir), "target")
    if period is not None:
        df = selection.filter_period(df, "period", period, must_exist=False)
    score = F.round(scoring.mean_score(_model_scores()), 6)
    return df.select(
        "user_id", "period", "target", "is_gone_in_two", "is_leaver", score.alias("score")
    )


@query
def score_month(spark, sf_dir):
    df = selection.filter_period(_labelled_days(spark, sf_dir), "period", SCORED_DAY, must_exist=False)
    score = scoring.clip_probability(_model_scores()[0])
    scores = stage(df.select("user_id", "period", score.alias("score")))
    return scoring.scored_table(scores, USER_DAY)


@query
def score_month_ensemble(spark, sf_dir):
    scores = stage(_scored_days(spark, sf_dir, SCORED_DAY).select("user_id", "period", "score"))
    return scoring.scored_table(scores, USER_DAY)


@query
def score_all_days(spark, sf_dir):
    """Rank within every day of the panel."""
    scores = stage(_scored_days(spark, sf_dir).select("user_id", "period", "score"))
    return rank_rows(
        scores, "score", "user_id", group=["period"], descending=True, row="rank_desc"
    )


@query
def head_report(spark, sf_dir):
    scores = _scored_days(spark, sf_dir).select("user_id", "period", "score")
    return scoring.head_report(scores, USER_DAY)


@query
def top_n_flag(spark, sf_dir):
    scores = stage(_scored_days(spark, sf_dir).select("user_id", "period", "score"))
    return scoring.top_n_flag(scores, USER_DAY, TOP_N)


@query
def top_n_missing_scores(spark, sf_dir):
    """More contacts than proper scores: rows without a score, NULL or NaN, come last."""
    score = F.when(F.col("user_id") % 3 == 0, F.lit(None)).when(F.col("user_id") % 3 == 1, F.lit(float("nan"))).otherwise(F.col("score"))
    scores = stage(_scored_days(spark, sf_dir).select("user_id", "period", score.cast("double").alias("score")))
    contacts = scores.filter(F.col("score").isNotNull() & ~F.isnan("score")).count() + TOP_N
    return scoring.top_n_flag(scores, USER_DAY, contacts).select("user_id", "period", "contact")


@query
def rank_wide_keys(spark, sf_dir):
    """Rank by a 64-bit key that a double cannot hold, ties by a text id, one group NULL."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = stage(orders.select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        (F.lit(2**62) + F.col("o_orderkey") % 1000).alias("wide_key"),
    ))
    return rank_rows(rows, "wide_key", "id", group=["status"], descending=True, row="rank_desc")


@query
def simple_export(spark, sf_dir):
    scores = stage(_scored_days(spark, sf_dir, SCORED_DAY).select("user_id", "period", "score"))
    return scoring.simple_export(scoring.scored_table(scores, USER_DAY), USER_DAY)


@query
def profit_curve(spark, sf_dir):
    scored = stage(_scored_days(spark, sf_dir).select("user_id", "period", "score", "is_gone_in_two"))
    return evaluation.profit_curve(scored, "score", "is_gone_in_two", USER_DAY.key)


def _curve(spark, sf_dir, group=()):
    scored = stage(_scored_days(spark, sf_dir).select("user_id", "period", "score", "is_gone_in_two"))
    return evaluation.profit_curve(scored, "score", "is_gone_in_two", USER_DAY.key, group)


@query
def profit_curve_max(spark, sf_dir):
    return evaluation.profit_peak(_curve(spark, sf_dir)).select("max_profit")


@query
def profit_argmax(spark, sf_dir):
    return evaluation.profit_peak(_curve(spark, sf_dir, ["period"]), ["period"])


@query
def profit_top_n(spark, sf_dir):
    return evaluation.profit_top_n(
        _scored_days(spark, sf_dir), "score", "is_gone_in_two", USER_DAY.key, TOP_N
    )


def _flagged(spark, sf_dir):
    flag = scoring.threshold_flag(F.col("score"), 0.25)
    return _scored_days(spark, sf_dir).select("*", flag.alias("contact"))


@query
def profit_threshold(spark, sf_dir):
    return evaluation.profit_at_threshold(_flagged(spark, sf_dir), "contact", "is_leaver")


@query
def profit_no_truth(spark, sf_dir):
    return evaluation.profit_at_threshold(
        _flagged(spark, sf_dir).drop("is_leaver"), "contact", "is_leaver"
    )


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(_flagged(spark, sf_dir), "contact", "is_leaver")


@query
def log_loss(spark, sf_dir):
    return evaluation.log_loss(_scored_days(spark, sf_dir), "score", "is_leaver")


@query
def coverage(spark, sf_dir):
    return evaluation.coverage(_flagged(spark, sf_dir), "contact")


@query
def join_truth_pred_inner(spark, sf_dir):
    """Truth of one day against the flags of the same day."""
    day = stage(_scored_days(spark, sf_dir, SCORED_DAY))
    flags = day.select(
        "user_id", scoring.threshold_flag(F.col("score"), 0.25).alias("contact")
    )
    return evaluation.join_truth_by_id(day, flags, USER_DAY, "is_gone_in_two", "contact")


@query
def join_pred_truth_left(spark, sf_dir):
    """All predictions against the truth of the days that have one."""
    days = stage(_scored_days(spark, sf_dir))
    last = selection.distinct_periods(days, "period")[-FUTURE_DAYS]
    known = days.filter(F.col("period") < last)
    predictions = days.select("user_id", "period", "score")
    return evaluation.with_truth(predictions, known, USER_DAY, "is_gone_in_two")


# -- models (rows only: no SQL equivalent) --------------------------------------------------

_TREES = {"maxIter": 5, "maxDepth": 3, "maxBins": 32}


def _matrix(spark, sf_dir, canaries=0):
    df = labels.class_weights(labels.binary_targets(_labelled_days(spark, sf_dir), "target"), "target")
    if canaries:
        df = sampling.canary_columns(df, USER_DAY, canaries)
    df = stage(df)
    available = selection.distinct_periods(df, "period")
    train = available[:-FUTURE_DAYS]
    matrix = training.train_matrix(
        df, USER_DAY, train, "is_leaver", "row_weight", "is_gone_in_two"
    )
    return df, matrix, available[-FUTURE_DAYS:]


@query
def train_matrix(spark, sf_dir):
    return _matrix(spark, sf_dir)[1].frame


def _predictions(models, df, matrix, periods):
    chosen = selection.filter_periods(df, "period", periods)
    scores = stage(scoring.predict(chosen, USER_DAY, models, matrix.features))
    return scoring.scored_table(scores, USER_DAY)


@query
def train_weighted_gbt(spark, sf_dir):
    df, matrix, future = _matrix(spark, sf_dir)
    return _predictions([training.train_weighted_gbt(matrix, **_TREES)], df, matrix, future)


@query
def train_seed_ensemble(spark, sf_dir):
    df, matrix, future = _matrix(spark, sf_dir)
    models = training.train_seed_ensemble(
        matrix, [12345, 12346, 12347], subsamplingRate=0.8, **_TREES
    )
    return _predictions(models, df, matrix, future)


@query
def profit_cv(spark, sf_dir):
    """All folds together, judged after every round up to the fixed number, stopped by profit."""
    _, matrix, _ = _matrix(spark, sf_dir)
    curve = boosting.validated(matrix, USER_DAY)
    rows = [(r, m, d, r == curve.best) for r, m, d in zip(curve.rounds, curve.means, curve.deviations)]
    return spark.createDataFrame(rows, "round int, mean_profit double, std_profit double, is_best boolean")


@query
def param_search(spark, sf_dir):
    """All trials, folds and ranges, every trial up to the fixed number of rounds or its early stop."""
    _, matrix, _ = _matrix(spark, sf_dir)
    return boosting.search(matrix, USER_DAY)


@query
def canary_importance_filter(spark, sf_dir):
    _, matrix, _ = _matrix(spark, sf_dir, canaries=fixed.CANARIES)
    return training.canary_importance_filter(matrix, **_TREES)


@query
def canary_pruned_trees(spark, sf_dir):
    """Trees over all noise columns that end where noise splits best: the future days, scored and ranked."""
    df, matrix, future = _matrix(spark, sf_dir, canaries=fixed.CANARIES)
    nodes = boosting.fit(matrix, 20, noise="canary_", maxDepth=5)
    chosen = selection.filter_periods(df, "period", future)
    scores = boosting.score_nodes(chosen, USER_DAY.key, nodes).drop("model")
    return scoring.scored_table(stage(scores), USER_DAY)


def _rule_nodes(spark, df):
    """Two ensembles of six two-level trees whose thresholds follow from the averages of the panel."""
    means = df.agg(*[F.avg(f).alias(f) for f in MODEL_FEATURES]).first()
    cut = {f: math.floor(means[f] or 0.0) + 0.5 for f in MODEL_FEATURES}
    rows = []
    for model, scale in ((0, 1.0), (1, 2.0)):
        rows.append((model, 0, 0, None, None, None, None, -1.0, None, None))
        for t, f in enumerate(MODEL_FEATURES, 1):
            after = MODEL_FEATURES[t % len(MODEL_FEATURES)]
            leaf = lambda n, v: (model, t, n, None, None, None, None, v * t * scale, None, None)  # noqa: B023, E731
            rows += [(model, t, 0, f, cut[f], 1, 2, 0.0, None, None), leaf(1, -0.05), (model, t, 2, after, cut[after], 3, 4, 0.0, None, None), leaf(3, 0.02), leaf(4, 0.1)]
    return spark.createDataFrame(rows, boosting.NODE_SCHEMA)


@query
def node_table_scores(spark, sf_dir):
    """An ensemble stored as a node table and evaluated level by level."""
    df = stage(_labelled_days(spark, sf_dir).select(*USER_DAY.key, *(F.col(f) for f in MODEL_FEATURES if f != "never_seen")).withColumn("never_seen", F.lit(0)))
    nodes = stage(_rule_nodes(spark, df))
    return boosting.score_nodes(df, USER_DAY.key, nodes)


# -- stored months, external files, sets ----------------------------------------------------


@query
def append_month_twice(spark, sf_dir):
    """A month written again replaces itself: the stored history after two appends of the last month."""
    panel = stage(panels.customer_month(spark, sf_dir).select("customer_id", "period", "activity"))
    last = selection.distinct_periods(panel, "period")[-1]
    path = f"{staging_dir(spark)}/monthly-{uuid.uuid4().hex}"
    monthly.append_period(panel.filter(F.col("period") < last), path, "period")
    for _ in range(2):
        monthly.append_period(panel.filter(F.col("period") == last), path, "period")
    return spark.read.parquet(path)


@query
def new_month_lags(spark, sf_dir):
    """Lags and deltas of the last month from carried rows; the history is not read."""
    columns = ["activity", "tenure"]
    panel = stage(panels.customer_month(spark, sf_dir).select("customer_id", "period", *columns))
    periods = selection.distinct_periods(panel, "period")
    path = f"{staging_dir(spark)}/monthly-{uuid.uuid4().hex}"
    earlier = monthly.carried_rows(panel.filter(F.col("period") < periods[-2]), CUSTOMER_MONTH, columns)
    month = panel.filter(F.col("period") == periods[-2])
    monthly.rolled_rows(earlier, month, CUSTOMER_MONTH, columns).write.parquet(f"{path}/state")
    monthly.append_period(panel.filter(F.col("period") == periods[-1]), f"{path}/panel", "period")
    return monthly.new_month_lags(spark, path, CUSTOMER_MONTH, columns, periods[-1])


@query
def csv_round_trip(spark, sf_dir):
    """The panel written as gzip CSV and read with a schema, beside a file with malformed lines."""
    panel = stage(panels.user_day(spark, sf_dir).select("user_id", "period", "events"))
    path = f"{staging_dir(spark)}/csv-{uuid.uuid4().hex}"
    monthly.write_csv_gzip(panel, path)
    bad = panel.where("user_id % 10 = 0").select(F.lit("no number").alias("user_id"), "period", "events")
    bad.write.mode("append").option("header", True).csv(path)
    good, wrong = monthly.read_csv_checked(spark, path, "user_id BIGINT, period BIGINT, events BIGINT")
    lines = wrong.groupBy(F.element_at(F.split("line", ","), 2).cast("long").alias("period")).agg(F.count(F.lit(1)).alias("malformed"))
    by_day = good.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("events").alias("events"), F.sum("user_id").alias("ids"))
    return by_day.join(lines, "period", "left").fillna(0, ["malformed"])


@query
def bucketed_join(spark, sf_dir):
    """Two stages stored in buckets of the customer, joined and windowed without an exchange."""
    panel = panels.customer_month(spark, sf_dir).select("customer_id", "period", "activity", "tenure")
    name = f"tidemark_{uuid.uuid4().hex}"
    monthly.use_stored_partitioning(spark)
    left = monthly.write_bucketed(panel.select("customer_id", "period", "activity"), f"{name}_a", "customer_id", "period", 8)
    right = monthly.write_bucketed(panel.select("customer_id", "period", "tenure"), f"{name}_b", "customer_id", "period", 8)
    joined = left.join(right, ["customer_id", "period"])
    so_far = Window.partitionBy("customer_id").orderBy("period")
    return joined.select("*", F.sum("activity").over(so_far).alias("activity_so_far"))


@query
def customers_in_both_months(spark, sf_dir):
    panel = panels.customer_month(spark, sf_dir)
    return selection.keys_in_both(panel, "customer_id", "period", 199701, 199702)


@query
def customers_only_in_month(spark, sf_dir):
    panel = panels.customer_month(spark, sf_dir)
    return selection.keys_only_in(panel, "customer_id", "period", 199701, 199702)


@query
def sketch_quantiles(spark, sf_dir):
    """Quantiles of merged month sketches: the values they cover, and whether the ranks keep the bound."""
    panel = _report_panel(spark, sf_dir)
    stored = stage(sketches.month_sketches(panel, "period", MEASURES))
    found = stage(sketches.sketch_quantiles(stored, [0.1, 0.25, 0.5, 0.75, 0.9]))
    errors = sketches.rank_errors(panel, found)
    return found.join(errors, ["column", "probability"]).select("column", "probability", "n", (F.col("error") <= sketches.RANK_ERROR).alias("within_bound"))
