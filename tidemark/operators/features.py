"""Feature families of the card, activity, risk and behaviour model.

Each function adds columns to a panel described by a :class:`PanelSpec`.  Windows run over
one entity's history, which holds one row per period, so a window group never exceeds the
number of periods however the raw rows are distributed.  Functions that need windowed
columns as inputs of further expressions use a second projection above the first; both
share the one exchange on the entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.periods import period_date
from ..functions.scalars import flag, ratio, relative_change, zero_sum
from ..spec import PanelSpec
from .ranking import standing


def base_combos(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Two-brand sums, activity sums and the date of the period."""
    c = {role: F.col(spec.role(role)) for role in spec.roles}
    return df.select(
        "*",
        period_date(spec.period).alias("period_date"),
        zero_sum(c["spend_a"], c["spend_b"]).alias("spend_total"),
        zero_sum(c["count_a"], c["count_b"]).alias("count_total"),
        zero_sum(c["limit_a"], c["limit_b"]).alias("limit_total"),
        zero_sum(c["count_a"], c["count_b"], c["sent_count"], c["cash_count"]).alias("tx_count"),
        zero_sum(
            c["spend_a"], c["spend_b"], c["sent_amount"], c["received_amount"]
        ).alias("tx_amount"),
    )


def sequence_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Lags, deltas, growth, moving averages, rolling extremes, running totals, ratios.

    Expects the columns of :func:`base_combos`.
    """
    h = spec.history
    spend_a, spend_b = spec.role("spend_a"), spec.role("spend_b")
    return df.select(
        "*",
        h.index().alias("history_index"),
        h.lag("spend_total").alias("spend_lag1"),
        h.lag("count_total").alias("count_lag1"),
        h.lag("tx_amount").alias("tx_amount_lag1"),
        h.lag("tx_count").alias("tx_count_lag1"),
        h.delta("spend_total").alias("spend_delta1"),
        h.delta("count_total").alias("count_delta1"),
        relative_change(F.col("spend_total"), h.lag("spend_total")).alias("spend_growth"),
        F.avg("spend_total").over(h.last(1)).alias("spend_avg1"),
        F.avg("spend_total").over(h.last(2)).alias("spend_avg2"),
        F.avg("spend_total").over(h.last(3)).alias("spend_avg3"),
        F.avg("count_total").over(h.last(3)).alias("count_avg3"),
        F.sum("tx_count").over(h.last(3)).alias("tx_count_sum3"),
        F.min("tx_amount").over(h.last(3)).alias("tx_amount_min3"),
        F.max("tx_amount").over(h.last(3)).alias("tx_amount_max3"),
        ratio(F.col("spend_total"), F.col("limit_total"), otherwise=0.0).alias("utilisation"),
        ratio(F.col("spend_total"), F.col("count_total")).alias("mean_ticket"),
        F.sum("spend_total").over(h.so_far).alias("spend_to_date"),
        F.sum("count_total").over(h.so_far).alias("count_to_date"),
        h.lag(spend_a).alias("spend_a_lag1"),
        h.lag(spend_b).alias("spend_b_lag1"),
        h.delta(spend_a).alias("spend_a_delta1"),
        h.delta(spend_b).alias("spend_b_delta1"),
    )


def trend_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Least-squares trend of spend over the whole history up to each row."""
    h = spec.history
    if "history_index" not in df.columns:
        df = df.select("*", h.index().alias("history_index"))
    return df.select(
        "*",
        F.regr_slope("spend_total", "history_index").over(h.so_far).alias("spend_slope"),
        F.regr_intercept("spend_total", "history_index").over(h.so_far).alias("spend_intercept"),
    )


def numeric_summary(df: DataFrame, spec: PanelSpec, id_alias: str = "entity_id") -> DataFrame:
    """The fixed numeric projection of the first step, with the id renamed."""
    roles = (
        "spend_a", "spend_b", "count_a", "count_b", "sent_amount", "received_amount",
        "cash_count", "sent_count",
    )
    return df.select(
        F.col(spec.id).alias(id_alias),
        spec.period,
        "period_date",
        "spend_total",
        "count_total",
        "limit_total",
        *[F.col(spec.role(r)) for r in roles],
        "tx_amount",
        "tx_count",
        "history_index",
    )


def activity_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Card balance, activity lags, deltas and the four-row moving average."""
    h = spec.history
    activity = spec.role("activity")
    return df.select(
        "*",
        zero_sum(F.col(spec.role("balance_a")), F.col(spec.role("balance_b"))).alias(
            "balance_total"
        ),
        *[h.lag(activity, k).alias(f"activity_lag{k}") for k in (1, 2, 3)],
        F.avg(activity).over(h.last(4)).alias("activity_avg4"),
        *[h.delta(activity, k).alias(f"activity_delta{k}") for k in (1, 2)],
    )


def tenure_rankings(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Row number, percent rank, cumulative distribution, quartile and decile of tenure
    among the entities of the same period; ties by id, NULL tenure last.

    A period may hold any share of the rows, so it is not one window group: see
    :func:`tidemark.operators.ranking.standing`.
    """
    ranked = standing(df, spec.role("tenure"), tie=spec.id, group=[spec.period])
    row, n = F.col("row_in_group"), F.col("group_size")

    def tile(k: int):
        small = F.floor(n / k)
        large = n % k
        split = large * (small + 1)
        return (
            F.when(row <= split, F.floor((row - 1) / (small + 1)) + 1)
            .otherwise(large + F.floor((row - split - 1) / F.greatest(small, F.lit(1))) + 1)
        )

    return ranked.select(
        *df.columns,
        row.alias("tenure_row"),
        F.when(n > 1, (F.col("rank_in_group") - 1) / (n - 1))
        .otherwise(F.lit(0.0))
        .alias("tenure_percent_rank"),
        (F.col("peers_end") / n).alias("tenure_cume_dist"),
        tile(4).alias("tenure_quartile"),
        tile(10).alias("tenure_decile"),
    )


def activity_rank_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Second step: activity history and tenure rankings."""
    return activity_features(tenure_rankings(df, spec), spec)


def rolling_activity_stats(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mean, maximum, minimum and slope (on tenure) of activity over four rows."""
    four = spec.history.last(4)
    activity, tenure = spec.role("activity"), spec.role("tenure")
    return df.select(
        "*",
        F.avg(activity).over(four).alias("activity_mean4"),
        F.max(activity).over(four).alias("activity_max4"),
        F.min(activity).over(four).alias("activity_min4"),
        F.regr_slope(activity, tenure).over(four).alias("activity_slope4"),
    )


ROLLING_STATS = ("activity_mean4", "activity_max4", "activity_min4", "activity_slope4")


def attach(
    left: DataFrame,
    right: DataFrame,
    spec: PanelSpec,
    columns: list[str] | tuple[str, ...],
    suffix: str | None = None,
) -> DataFrame:
    """Left join ``columns`` of ``right`` on the panel key.

    The period of the right side is cast to the type of the left side.  A name that exists
    on both sides gets ``suffix``, or raises when no suffix is given.
    """
    clashes = [c for c in columns if c in left.columns]
    if clashes and suffix is None:
        raise ValueError(f"columns exist on both sides: {clashes}")
    side = right.select(
        F.col(spec.id),
        F.col(spec.period).cast(left.schema[spec.period].dataType).alias(spec.period),
        *[F.col(c).alias(c + suffix if c in clashes else c) for c in columns],
    )
    return left.join(side, spec.key, "left")


def rolling_stats_joined(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Third step in its join form: the rolling statistics as a table joined back."""
    narrow = df.select(*spec.key, spec.role("activity"), spec.role("tenure"))
    return attach(df, rolling_activity_stats(narrow, spec), spec, ROLLING_STATS)


RISK_COLUMNS = (
    "activity_drop_share", "flag_activity_drop", "flag_two_periods_down",
    "flag_near_inactive", "flag_high_utilisation", "flag_small_ticket_often",
    "tx_amount_range3", "tx_amount_relative_range3", "received_delta1", "flag_income_drop",
    "activity_per_tenure", "flag_old_low_use", "flag_spend_falling",
)


def risk_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Fourth step: disengagement, credit stress, volatility, income and tenure signals.

    Expects the columns of the first three steps.
    """
    h = spec.history
    activity, tenure = F.col(spec.role("activity")), F.col(spec.role("tenure"))
    received = spec.role("received_amount")
    lag1 = F.col("activity_lag1")
    high, low = F.col("tx_amount_max3"), F.col("tx_amount_min3")
    received_before = h.lag(received)
    return df.select(
        "*",
        relative_change(activity, lag1).alias("activity_drop_share"),
        flag((lag1 > 0) & (activity < fixed.DROP_SHARE * lag1)).alias("flag_activity_drop"),
        flag((F.col("activity_delta1") < 0) & (F.col("activity_delta2") < 0)).alias(
            "flag_two_periods_down"
        ),
        flag(
            (activity <= fixed.INACTIVE_AT_MOST)
            & (F.coalesce(lag1, F.lit(0)) > fixed.INACTIVE_AT_MOST)
        ).alias("flag_near_inactive"),
        flag(F.col("utilisation") > fixed.HIGH_UTILISATION).alias("flag_high_utilisation"),
        flag(
            (F.col("mean_ticket") < fixed.LOW_TICKET) & (F.col("tx_count") > fixed.HIGH_FREQUENCY)
        ).alias("flag_small_ticket_often"),
        (high - low).alias("tx_amount_range3"),
        F.when(F.abs(high) > fixed.NEAR_ZERO, (high - low) / F.abs(high)).alias(
            "tx_amount_relative_range3"
        ),
        h.delta(received).alias("received_delta1"),
        flag(
            (received_before > 0) & (F.col(received) < fixed.DROP_SHARE * received_before)
        ).alias("flag_income_drop"),
        ratio(activity, tenure).alias("activity_per_tenure"),
        flag(
            (tenure >= fixed.VETERAN_TENURE) & (activity <= fixed.INACTIVE_AT_MOST)
        ).alias("flag_old_low_use"),
        flag(F.col("spend_slope") < 0).alias("flag_spend_falling"),
    )


def behaviour_features(df: DataFrame, spec: PanelSpec, total: str = "spend_to_date") -> DataFrame:
    """Fifth step: lags and deltas, own-history comparisons, variability, flow ratios.

    ``total`` is the "total amount" of this step.  In the model it is the running spend,
    not the amount of the period, hence the default.
    """
    h = spec.history
    three = h.last(3)
    role = {r: F.col(spec.role(r)) for r in ("activity", "tenure", "sent_amount", "received_amount")}
    activity, tenure = role["activity"], role["tenure"]
    sent, received = role["sent_amount"], role["received_amount"]
    tracked = {
        "utilisation": F.col("utilisation"),
        "mean_ticket": F.col("mean_ticket"),
        "tx_count": F.col("tx_count"),
        "activity": activity,
        "spend": F.col("spend_total"),
        "total": F.col(total),
    }
    spend, limit = F.col("spend_total"), F.col("limit_total")
    balance_share = ratio(F.col("balance_total"), limit)

    windowed = df.select(
        "*",
        *[h.lag(c).alias(f"{n}_before") for n, c in tracked.items()],
        *[(c - h.lag(c)).alias(f"{n}_change") for n, c in tracked.items()],
        F.max(activity).over(h.so_far).alias("activity_max_to_date"),
        F.avg(activity).over(h.so_far).alias("activity_avg_to_date"),
        F.avg(spend).over(h.so_far).alias("spend_avg_to_date"),
        F.stddev_samp(activity).over(three).alias("activity_std3"),
        F.avg(activity).over(three).alias("activity_avg3"),
        F.stddev_samp(spend).over(three).alias("spend_std3"),
        F.avg(spend).over(three).alias("spend_mean3"),
        F.sum(flag(activity < fixed.INACTIVE_AT_MOST)).over(three).alias("low_activity_count3"),
        F.sum(flag(received.isNull() | (received == 0))).over(three).alias("no_income_count3"),
        ratio(received, sent).alias("received_per_sent"),
        balance_share.alias("balance_per_limit"),
        flag(balance_share > fixed.MAXED_CREDIT).alias("flag_credit_maxed"),
        ratio(spend, F.col("tx_count")).alias("spend_per_tx"),
        ratio(spend, activity).alias("spend_per_activity"),
        ratio(spend, F.col(total)).alias("spend_per_total"),
        flag(tenure < fixed.RECENT_TENURE).alias("flag_recent"),
        flag(
            (tenure >= fixed.VETERAN_TENURE) & (activity <= fixed.INACTIVE_AT_MOST)
        ).alias("flag_veteran_idle"),
    )
    return windowed.select(
        "*",
        ratio(activity, F.col("activity_max_to_date")).alias("activity_vs_best"),
        ratio(spend, F.col("spend_avg_to_date")).alias("spend_vs_usual"),
        flag(F.col("low_activity_count3") >= fixed.LONG_INACTIVITY).alias("flag_long_inactive"),
        ratio(F.col("activity_std3"), F.col("activity_avg3")).alias("activity_cv3"),
        ratio(F.col("spend_std3"), F.col("spend_mean3")).alias("spend_cv3"),
    )


def card_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """First step: sums, sequence features and trend."""
    return trend_features(sequence_features(base_combos(df, spec), spec), spec)


def features_full(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """All five steps.

    The tenure rankings come first: they order rows across entities, everything after
    them runs on one exchange by entity.
    """
    df = tenure_rankings(df, spec)
    for step in (
        card_features, activity_features, rolling_activity_stats, risk_features, behaviour_features,
    ):
        df = step(df, spec)
    return df
