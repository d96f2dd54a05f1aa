"""The three panels derived from the order, line-item and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import INDEX, month_number
from ..spec import PanelSpec

MEASURES = [
    "spend_f", "spend_o", "count_f", "count_o", "limit_f", "limit_o", "balance_f", "balance_o",
    "sent_amount", "received_amount", "sent_count", "bulk_count", "activity", "tenure",
]

#: lags and deltas of the wide report
WIDE_STEPS = (1, 2, 3, 4, 5)

MONEY = [
    "spend_f", "spend_o", "limit_f", "limit_o", "balance_f", "balance_o", "sent_amount",
    "received_amount",
]

_ROLES = {
    "spend_a": "spend_f", "spend_b": "spend_o", "count_a": "count_f", "count_b": "count_o",
    "limit_a": "limit_f", "limit_b": "limit_o", "balance_a": "balance_f",
    "balance_b": "balance_o", "sent_amount": "sent_amount",
    "received_amount": "received_amount", "sent_count": "sent_count",
    "cash_count": "bulk_count", "activity": "activity", "tenure": "tenure",
}
CUSTOMER_MONTH = PanelSpec("customer_id", "period", "target", roles=_ROLES)
SUPPLIER_MONTH = PanelSpec("supplier_id", "period", "target", roles=_ROLES)
USER_DAY = PanelSpec("user_id", "period", "target", granularity=INDEX)

EVENT_TYPES = ["view", "click", "error", "purchase", "signup"]
USER_MEASURES = ["events", "value_sum", "value_avg", "value_max", *[f"n_{t}" for t in EVENT_TYPES]]

#: groups of the supplier panel; one of them has no member in it
GROUPS = {
    "spend_sum": ["spend_f", "spend_o"],
    "limit_sum": ["limit_f", "limit_o"],
    "balance_sum": ["balance_f", "balance_o"],
    "flow_sum": ["sent_amount", "received_amount"],
    "foreign_sum": ["spend_foreign", "limit_foreign"],
    "count_sum": ["count_f", "count_o", "sent_count"],
}
GROUPS_NOT_SMOOTHED = ("count_sum",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(amount: str) -> str:
    # whole cents add up to the same total in any order
    return f"floor(({amount}) * 100 + 0.5D)"


def _month(ts: str) -> str:
    return f"CAST(year({ts}) * 100 + month({ts}) AS INT)"


def _line_amounts() -> dict[str, str]:
    """What one line item adds to each measure, money in whole cents."""
    price = _cents("l_extendedprice")
    limit = _cents("l_extendedprice * (1 + l_tax)")
    balance = _cents("l_extendedprice * l_tax")
    amounts: dict[str, str] = {}
    for brand in ("F", "O"):
        name = brand.lower()
        for measure, value in (
            ("spend", price), ("count", "1"), ("limit", limit), ("balance", balance)
        ):
            amounts[f"{measure}_{name}"] = f"CASE WHEN l_linestatus = '{brand}' THEN {value} END"
    amounts["sent_amount"] = _cents("l_extendedprice * l_discount")
    amounts["received_amount"] = f"CASE WHEN l_returnflag = 'A' THEN {price} END"
    amounts["sent_count"] = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"
    amounts["bulk_count"] = "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END"
    amounts["activity"] = "1"
    return amounts


def _summed(df: DataFrame, keys: list[str], amounts: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(f"sum({a}) AS {n}") for n, a in amounts.items()])


def _finished(summed: DataFrame, spec: PanelSpec) -> DataFrame:
    """Cents to money, and the tenure: months since the entity's first month, plus 1."""
    first = F.first(spec.period).over(spec.history.so_far)
    tenure = month_number(spec.period) - month_number(first) + 1
    return summed.select(
        *spec.key,
        *[F.expr(f"{m} / 100.0D AS {m}") if m in MONEY else m for m in MEASURES[:-1]],
        tenure.cast("int").alias("tenure"),
    )


def customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer x order month.

    Lines are summed per order first: a hot order is combined before the shuffle, and the
    join reuses the partitioning of that sum.  The second sum combines a hot customer.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.expr(_month("o_orderdate")).alias("period"),
    )
    amounts = _line_amounts()
    per_order = _summed(table(spark, sf_dir, "lineitem"), ["l_orderkey"], amounts)
    joined = per_order.join(orders, "l_orderkey")
    summed = _summed(joined, CUSTOMER_MONTH.key, {n: n for n in amounts})
    return _finished(summed, CUSTOMER_MONTH)


def supplier_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier x ship month."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "*", "l_suppkey AS supplier_id", f"{_month('l_shipdate')} AS period"
    )
    return _finished(_summed(lines, SUPPLIER_MONTH.key, _line_amounts()), SUPPLIER_MONTH)


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x day (days since 1970)."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.unix_date(F.to_date("ts")).alias("period"), "event_type", "value"
    )
    panel = events.groupBy("user_id", "period").agg(
        F.count(F.lit(1)).alias("events"),
        F.expr(f"sum({_cents('value')}) / 100.0D AS value_sum"),
        F.max("value").alias("value_max"),
        *[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in EVENT_TYPES],
    )
    return panel.select(
        "user_id", "period", "events", "value_sum",
        (F.col("value_sum") / F.col("events")).alias("value_avg"),
        "value_max", *[f"n_{t}" for t in EVENT_TYPES],
    )
