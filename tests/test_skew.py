"""A third of all rows under one key, one value or one period: results stay exact."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_points

NAMES = [
    "panel_customer_month", "panel_supplier_month", "panel_user_day", "attrition_label",
    "activity_rank_features", "features_v3", "psi_by_column_month", "outlier_by_month",
    "undersample_majority", "stratified_folds", "profit_curve", "profit_argmax", "top_n_flag",
]


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    rng = np.random.default_rng(8)
    n_orders, n_lines, n_events = 900, 6000, 6000

    def hot(size, values):
        return np.where(rng.random(size) < 1 / 3, 1, rng.integers(2, values, size))

    days = pd.to_datetime("1995-01-01") + pd.to_timedelta(rng.integers(0, 1500, n_orders), "D")
    orders = pd.DataFrame(
        {
            "o_orderkey": np.arange(1, n_orders + 1),
            "o_custkey": hot(n_orders, 120),
            "o_orderstatus": "F",
            "o_totalprice": 1.0,
            "o_orderdate": days.astype("datetime64[us]"),
            "o_orderpriority": "1",
        }
    )
    # a third of the lines belongs to one order, one supplier, one price and one month
    ship = pd.to_datetime("1995-01-15") + pd.to_timedelta(
        np.where(rng.random(n_lines) < 1 / 3, 0, rng.integers(0, 1500, n_lines)), "D"
    )
    lines = pd.DataFrame(
        {
            "l_orderkey": hot(n_lines, n_orders),
            "l_partkey": rng.integers(1, 200, n_lines),
            "l_suppkey": hot(n_lines, 60),
            "l_linenumber": 1,
            "l_quantity": rng.integers(1, 50, n_lines).astype(float),
            "l_extendedprice": np.where(
                rng.random(n_lines) < 1 / 3, 100.0, rng.integers(100, 10_000_000, n_lines) / 100
            ),
            "l_discount": rng.integers(0, 10, n_lines) / 100,
            "l_tax": rng.integers(0, 8, n_lines) / 100,
            "l_returnflag": rng.choice(["A", "N", "R"], n_lines),
            "l_linestatus": rng.choice(["F", "O"], n_lines),
            "l_shipdate": ship.astype("datetime64[us]"),
        }
    )
    when = pd.to_datetime("2024-01-01") + pd.to_timedelta(
        np.where(rng.random(n_events) < 1 / 3, 3600, rng.integers(0, 30 * 86400, n_events)), "s"
    )
    events = pd.DataFrame(
        {
            "event_id": np.arange(n_events),
            "ts": when.astype("datetime64[us]"),
            "user_id": hot(n_events, 150),
            "event_type": rng.choice(["view", "click", "error", "purchase", "signup"], n_events),
            "value": np.where(rng.random(n_events) < 1 / 3, 5.0, rng.integers(1, 40_000, n_events) / 100),
            "props": "{}",
        }
    )
    for name, df in (("orders", orders), ("lineitem", lines), ("events", events)):
        df.to_parquet(folder / f"{name}.parquet", index=False)
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_tables(spark, skewed_dir, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{skewed_dir}/{t}.parquet'")
    cursor = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    df = entry_points.queries()[name](spark, skewed_dir)
    order = sorted(names)
    expected = sorted(repr([r[names.index(c)] for c in order]) for r in cursor.fetchall())
    assert sorted(repr([r[c] for c in order]) for r in df.collect()) == expected
