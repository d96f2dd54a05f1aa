"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and
cores.  Every query runs over its whole tables and writes all of its rows to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "panel_customer_month",
    "panel_supplier_month",
    "panel_user_day",
    "attrition_label",
    "label_by_join",
    "targets_and_weights",
    "sequence_features",
    "trend_features",
    "activity_rank_features",
    "rolling_stats_joined",
    "risk_features",
    "behaviour_features",
    "features_full",
    "features_full_sql",
    "group_sums",
    "lags_deltas_all",
    "ema",
    "rolling_max_min",
    "features_v2",
    "features_v3",
    "drift_by_month",
    "outlier_by_month",
    "months_to_drop",
    "append_snapshot_month",
    "undersample_majority",
    "stratified_folds",
    "score_month_ensemble",
    "score_all_days",
    "top_n_flag",
    "profit_curve",
    "profit_argmax",
    "log_loss",
    "train_weighted_gbt",
]
#: input tables of the queries, for rows per second
_SOURCES = {
    "panel_user_day", "targets_and_weights", "stratified_folds", "score_month_ensemble",
    "score_all_days", "top_n_flag", "profit_curve", "profit_argmax", "log_loss",
    "train_weighted_gbt",
}


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main() -> None:
    from tidemark.plans.registry import QUERIES
    from tidemark.sources.staging import drop_staged

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "events")}

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("panel_customer_month")  # starts executors and warms the JVM
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(run(name), 3)
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
        drop_staged(spark)
    per_second = {
        n: round(rows["events" if n in _SOURCES else "lineitem"] / s) for n, s in seconds.items()
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input_rows_per_sec": per_second,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
