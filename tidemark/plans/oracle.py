"""The same queries as plain SQL over the Parquet tables, for checking results."""

from __future__ import annotations

from ..functions import fixed_values as fixed
from . import sql_steps
from .compare import comparable_sql, rounded_sql
from .panels import (
    CUSTOMER_MONTH, EVENT_TYPES, GROUPS, GROUPS_NOT_SMOOTHED, MEASURES, SUPPLIER_MONTH,
    USER_MEASURES, WIDE_STEPS,
)
from .registry import FIRST_PERIOD, FUTURE_DAYS, MODEL_FEATURES, SCORED_DAY, TOP_N

_LONG_MEASURES = "count_f count_o sent_count bulk_count activity tenure"
_MONEY_MEASURES = (
    "spend_f spend_o limit_f limit_o balance_f balance_o sent_amount received_amount"
)

# -- panels ---------------------------------------------------------------------------------


def _money(amount: str, condition: str = "true") -> str:
    return (
        f"CAST(sum(CASE WHEN {condition} THEN CAST(floor(({amount}) * 100 + 0.5) AS BIGINT) END)"
        " AS DOUBLE) / 100"
    )


def _month(ts: str) -> str:
    return f"CAST(year({ts}) * 100 + month({ts}) AS INTEGER)"


def _month_number(p: str) -> str:
    return f"(CAST(floor({p} / 100) AS BIGINT) * 12 + {p} % 100 - 1)"


def _line_panel(source: str, entity: str, entity_sql: str, period_sql: str) -> str:
    measures = []
    for brand in ("F", "O"):
        cond, name = f"l_linestatus = '{brand}'", brand.lower()
        measures += [
            f"{_money('l_extendedprice', cond)} AS spend_{name}",
            f"sum(CASE WHEN {cond} THEN 1 END) AS count_{name}",
            f"{_money('l_extendedprice * (1 + l_tax)', cond)} AS limit_{name}",
            f"{_money('l_extendedprice * l_tax', cond)} AS balance_{name}",
        ]
    received = "l_returnflag = 'A'"
    measures += [
        f"{_money('l_extendedprice * l_discount')} AS sent_amount",
        f"{_money('l_extendedprice', received)} AS received_amount",
        "count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS sent_count",
        "count(CASE WHEN l_quantity > 25 THEN 1 END) AS bulk_count",
        "count(*) AS activity",
    ]
    listed = ",\n      ".join(measures)
    first = f"min(period) OVER (PARTITION BY {entity})"
    return f"""(
    SELECT *, {_month_number('period')} - {_month_number(first)} + 1 AS tenure
    FROM (
      SELECT {entity_sql} AS {entity}, {period_sql} AS period,
      {listed}
      FROM {source}
      GROUP BY 1, 2
    ) grouped
  )"""


CM = "cm AS " + _line_panel(
    "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "customer_id", "o_custkey", _month("o_orderdate"),
)
SM = "sm AS " + _line_panel("lineitem", "supplier_id", "l_suppkey", _month("l_shipdate"))
_COUNTS = ",\n    ".join(
    f"count(CASE WHEN event_type = '{t}' THEN 1 END) AS n_{t}" for t in EVENT_TYPES
)
UD = f"""ud AS (
  SELECT *, value_sum / events AS value_avg FROM (
    SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
    count(*) AS events,
    {_money('value')} AS value_sum,
    max(value) AS value_max,
    {_COUNTS}
    FROM events GROUP BY 1, 2
  ) grouped
)"""
_UD_LONGS = "user_id period events " + " ".join(f"n_{t}" for t in EVENT_TYPES)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _labelled(name: str, source: str, entity: str, next_period: str, second_period: str) -> str:
    return f"""{name} AS (
  SELECT p.*,
    CASE WHEN a.period IS NULL THEN '{fixed.GONE_NEXT}'
         WHEN b.period IS NULL THEN '{fixed.GONE_IN_TWO}'
         ELSE '{fixed.STAYS}' END AS target
  FROM {source} p
  LEFT JOIN (SELECT DISTINCT {entity}, period FROM {source}) a
    ON p.{entity} = a.{entity} AND a.period = {next_period}
  LEFT JOIN (SELECT DISTINCT {entity}, period FROM {source}) b
    ON p.{entity} = b.{entity} AND b.period = {second_period}
)"""


def _add_months(p: str, k: int) -> str:
    n = f"({_month_number(p)} + {k})"
    return f"(CAST(floor({n} / 12) AS BIGINT) * 100 + ({n} % 12 + 12) % 12 + 1)"


def _monthly(name: str, source: str, entity: str) -> str:
    return _labelled(name, source, entity, _add_months("p.period", 1), _add_months("p.period", 2))


DAYS = _labelled("days", "ud", "user_id", "p.period + 1", "p.period + 2")
TARGETS = f"""targets AS (
  SELECT *,
    CASE WHEN target = '{fixed.GONE_IN_TWO}' THEN 1 ELSE 0 END AS is_gone_in_two,
    CASE WHEN target = '{fixed.STAYS}' THEN 0 ELSE 1 END AS is_leaver
  FROM days
)"""

# -- the five feature steps -----------------------------------------------------------------


def _ranked(base: str) -> str:
    """The rankings of tenure inside a period, by plain windows."""
    entity = "customer_id" if base == "cm" else "supplier_id"
    rows = f"(PARTITION BY period ORDER BY tenure NULLS LAST, {entity})"
    peers = "(PARTITION BY period ORDER BY tenure NULLS LAST)"
    return f"""ranked AS (
  SELECT *, row_number() OVER {rows} AS tenure_row,
    percent_rank() OVER {peers} AS tenure_percent_rank, cume_dist() OVER {peers} AS tenure_cume_dist,
    ntile(4) OVER {rows} AS tenure_quartile, ntile(10) OVER {rows} AS tenure_decile
  FROM {base}
)"""


def _steps(spec) -> list[str]:
    params = sql_steps.parameters(spec, "ranked")
    return [
        f"{s.name} AS (\n{sql_steps.render(s.template, params)})" for s in sql_steps.standard_steps()
    ]


_STEP1_LONGS = "history_index count_total tx_count count_lag1 tx_count_lag1 count_delta1 tx_count_sum3 count_to_date"
_COMBO_DOUBLES = "spend_total limit_total tx_amount"
_SEQUENCE_DOUBLES = (
    "spend_lag1 tx_amount_lag1 spend_delta1 spend_growth spend_avg1 spend_avg2 spend_avg3 "
    "count_avg3 tx_amount_min3 tx_amount_max3 utilisation mean_ticket spend_to_date "
    "spend_a_lag1 spend_b_lag1 spend_a_delta1 spend_b_delta1"
)
_TREND_DOUBLES = "spend_slope spend_intercept"
_STEP2_LONGS = (
    "activity_lag1 activity_lag2 activity_lag3 activity_delta1 activity_delta2 "
    "tenure_row tenure_quartile tenure_decile"
)
_STEP2_DOUBLES = "balance_total activity_avg4 tenure_percent_rank tenure_cume_dist"
_STEP3_LONGS = "activity_max4 activity_min4"
_STEP3_DOUBLES = "activity_mean4 activity_slope4"
_STEP4_LONGS = (
    "flag_activity_drop flag_two_periods_down flag_near_inactive flag_high_utilisation "
    "flag_small_ticket_often flag_income_drop flag_old_low_use flag_spend_falling"
)
_STEP4_DOUBLES = (
    "activity_drop_share tx_amount_range3 tx_amount_relative_range3 received_delta1 "
    "activity_per_tenure"
)
_STEP5_LONGS = (
    "tx_count_before activity_before tx_count_change activity_change activity_max_to_date "
    "low_activity_count3 no_income_count3 flag_credit_maxed flag_recent flag_veteran_idle "
    "flag_long_inactive"
)
_STEP5_DOUBLES = (
    "utilisation_before mean_ticket_before spend_before total_before utilisation_change "
    "mean_ticket_change spend_change total_change activity_avg_to_date spend_avg_to_date "
    "activity_std3 activity_avg3 spend_std3 spend_mean3 received_per_sent balance_per_limit "
    "spend_per_tx spend_per_activity spend_per_total activity_vs_best spend_vs_usual "
    "activity_cv3 spend_cv3"
)


def _features(base_cte: str, base: str, spec, step: int, longs: str, doubles: str, others="") -> str:
    steps = _steps(spec)
    names = [s.split(" ", 1)[0] for s in steps]
    key = " ".join(spec.key)
    return _with(base_cte, _ranked(base), *steps[:step]) + comparable_sql(
        names[step - 1], f"{key} {longs}", doubles, others
    )


def _full_features() -> str:
    return _features(
        CM, "cm", CUSTOMER_MONTH, 5,
        " ".join([_LONG_MEASURES, _STEP1_LONGS, _STEP2_LONGS, _STEP3_LONGS, _STEP4_LONGS, _STEP5_LONGS]),
        " ".join([
            _MONEY_MEASURES, _COMBO_DOUBLES, _SEQUENCE_DOUBLES, _TREND_DOUBLES, _STEP2_DOUBLES,
            _STEP3_DOUBLES, _STEP4_DOUBLES, _STEP5_DOUBLES,
        ]),
        "period_date",
    )


# -- generated features ---------------------------------------------------------------------


def _sum_of(members: list[str]) -> str:
    present = [m for m in members if m in MEASURES]
    return " + ".join(f"coalesce({m}, 0)" for m in present) or "0"


GS = "gs AS (SELECT *, " + ", ".join(f"{_sum_of(m)} AS {g}" for g, m in GROUPS.items()) + " FROM sm)"
_LONG_GROUPS = ["foreign_sum", "count_sum"]
_GROUP_DOUBLES = [g for g in GROUPS if g not in _LONG_GROUPS]
_SMOOTHED = [g for g in GROUPS if g not in GROUPS_NOT_SMOOTHED]
_HIST = "PARTITION BY supplier_id ORDER BY period"


def _lags(columns: list[str], steps: tuple[int, ...] = (1, 2)) -> list[str]:
    return [
        e
        for c in columns
        for k in steps
        for e in (
            f"lag({c}, {k}) OVER hist AS {c}_lag{k}",
            f"{c} - lag({c}, {k}) OVER hist AS {c}_d{k}",
        )
    ]


def _lag_names(columns: list[str]) -> str:
    return " ".join(f"{c}_{s}{k}" for c in columns for s in ("lag", "d") for k in (1, 2))


def _smoothing() -> tuple[list[str], str, str]:
    """Expressions, double names, long names of the averages and extremes."""
    expressions, doubles, longs = [], [], []
    for c in _SMOOTHED:
        for alpha in fixed.EMA_ALPHAS:
            name = f"{c}_ema_alpha{str(alpha).replace('.', 'p')}"
            r = 1 - alpha
            weighted = f"sum({{v}} * pow({r}, -rn)) OVER (hist ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            expressions.append(f"{weighted.format(v=c)} / {weighted.format(v=1)} AS {name}")
            doubles.append(name)
        for n in fixed.EXTREME_WINDOWS:
            for f in ("max", "min"):
                name = f"{c}_{f}_win{n}"
                expressions.append(
                    f"{f}({c}) OVER (hist ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {name}"
                )
                (longs if c in _LONG_GROUPS else doubles).append(name)
    return expressions, " ".join(doubles), " ".join(longs)


_SMOOTH_SQL, _SMOOTH_DOUBLES, _SMOOTH_LONGS = _smoothing()
RN = f"rn AS (SELECT *, row_number() OVER ({_HIST}) AS rn FROM gs)"
_LONG_LIST = _LONG_MEASURES.split()
_MONEY_LIST = _MONEY_MEASURES.split()


def _generated(expressions: list[str], source: str, where: str = "") -> str:
    listed = ",\n  ".join(expressions)
    return f"made AS (SELECT *,\n  {listed}\n  FROM {source} WINDOW hist AS ({_HIST}))"


def _of_kind(names: str, part: str) -> str:
    return " ".join(n for n in names.split() if part in n)


# -- drift and outliers ---------------------------------------------------------------------

_GRID = ", ".join(f"CAST({i * (1.0 / fixed.PSI_BUCKETS)!r} AS DOUBLE)" for i in range(fixed.PSI_BUCKETS))
_GRID += ", CAST(1.0 AS DOUBLE)"


def _long_form(columns: list[str], source: str) -> str:
    each = [f"  SELECT period, '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns]
    return "vals AS (\n" + "\n  UNION ALL\n".join(each) + "\n)"


LONG_FORM = _long_form(MEASURES, "sm")
_WIDE = [f"{c}_{s}{k}" for c in MEASURES for s in ("lag", "d") for k in WIDE_STEPS]
_EPS = fixed.PSI_EPSILON
PSI = f"""base AS (
  SELECT DISTINCT period FROM sm ORDER BY period DESC LIMIT {fixed.BASELINE_PERIODS}
), cuts AS (
  SELECT col, list_sort(list_distinct(quantile_cont(v, [{_GRID}]))) AS cut
  FROM vals WHERE period IN (SELECT period FROM base) AND v IS NOT NULL GROUP BY col
), binned AS (
  SELECT w.period, w.col, w.v, len(c.cut) - 1 AS bins,
    CASE WHEN w.v BETWEEN c.cut[1] AND c.cut[len(c.cut)]
         THEN least(len(list_filter(c.cut, lambda x: x <= w.v)), len(c.cut) - 1) END AS bin
  FROM vals w LEFT JOIN cuts c ON w.col = c.col
), expected AS (
  SELECT col, bin, count(*) AS n FROM binned
  WHERE period IN (SELECT period FROM base) AND bin IS NOT NULL GROUP BY col, bin
), expected_total AS (SELECT col, sum(n) AS n FROM expected GROUP BY col
), actual AS (
  SELECT period, col, bin, count(*) AS n FROM binned WHERE bin IS NOT NULL GROUP BY period, col, bin
), cells AS (
  SELECT period, col, any_value(bins) AS bins, count(v) AS valid, count(bin) AS n
  FROM binned GROUP BY period, col
), terms AS (
  SELECT g.period, g.col, g.bins, g.valid, g.n,
    greatest(least(CAST(coalesce(e.n, 0) AS DOUBLE) / t.n, 1.0), {_EPS!r}) AS e,
    CASE WHEN g.n > 0 THEN greatest(least(CAST(coalesce(a.n, 0) AS DOUBLE) / g.n, 1.0), {_EPS!r}) END AS a
  FROM (SELECT *, unnest(range(1, greatest(bins, 1) + 1)) AS bin FROM cells) g
  LEFT JOIN expected e ON e.col = g.col AND e.bin = g.bin
  LEFT JOIN expected_total t ON t.col = g.col
  LEFT JOIN actual a ON a.period = g.period AND a.col = g.col AND a.bin = g.bin
), psi AS (
  SELECT period, col AS "column",
    CASE WHEN any_value(valid) = 0 OR any_value(bins) IS NULL THEN NULL
         WHEN any_value(bins) = 0 THEN 0.0
         WHEN any_value(n) > 0 THEN sum((e - a) * ln(e / a)) END AS psi
  FROM terms GROUP BY period, col
)"""
_N = len(MEASURES)


def _summary(name: str, source: str, value: str, limits: tuple[float, float], flag: str) -> str:
    low, high = limits
    return f"""{name} AS (
  SELECT *, coalesce(avg_{value} > {low}, false)
    OR columns_over_high > {_N} * {fixed.FLAGGED_COLUMN_SHARE} AS {flag}
  FROM (
    SELECT period, avg({value}) AS avg_{value}, max({value}) AS max_{value},
      count(CASE WHEN {value} > {low} THEN 1 END) AS columns_over_low,
      count(CASE WHEN {value} > {high} THEN 1 END) AS columns_over_high,
      make_date(CAST(floor(period / 100) AS INTEGER), CAST(period % 100 AS INTEGER), 1) AS period_date
    FROM {source} GROUP BY period
  ) by_period
)"""


DRIFT = _summary("drift", "psi", "psi", fixed.PSI_LIMITS, "drift_flag")
RATES = f"""bounds AS (
  SELECT col, q[1] - {fixed.IQR_FACTOR} * (q[2] - q[1]) AS lo, q[2] + {fixed.IQR_FACTOR} * (q[2] - q[1]) AS hi
  FROM (SELECT col, quantile_cont(v, [CAST(0.25 AS DOUBLE), CAST(0.75 AS DOUBLE)]) AS q
        FROM vals WHERE v IS NOT NULL GROUP BY col) quartiles
), rates AS (
  SELECT period, col AS "column",
    CASE WHEN count(v) > 0
         THEN CAST(count(CASE WHEN v < lo OR v > hi THEN 1 END) AS DOUBLE) / count(*) END AS outlier_rate
  FROM vals LEFT JOIN bounds USING (col) GROUP BY period, col
)"""
OUTLIERS = _summary("outliers", "rates", "outlier_rate", fixed.OUTLIER_LIMITS, "outlier_flag")
BAD = """bad AS (
  SELECT period FROM drift WHERE drift_flag UNION SELECT period FROM outliers WHERE outlier_flag
)"""

# -- scores ---------------------------------------------------------------------------------


def _logistic(x: str) -> str:
    return f"round(1.0 / (1.0 + exp(-({x}))), 6)"


_SCORES = [
    _logistic("CAST(0.8 AS DOUBLE) * n_error - CAST(0.3 AS DOUBLE) * n_purchase - 1.0"),
    _logistic("CAST(0.01 AS DOUBLE) * value_sum - 2.0"),
    _logistic("CAST(0.02 AS DOUBLE) * value_max - CAST(0.5 AS DOUBLE) * events"),
]
_M = fixed.PROBABILITY_MARGIN


def _clip(p: str) -> str:
    return f"greatest(least({p}, CAST({1 - _M!r} AS DOUBLE)), CAST({_M!r} AS DOUBLE))"


_MEAN = _clip("(" + " + ".join(_clip(s) for s in _SCORES) + ") / 3.0")
SCORED = f"""scored AS (
  SELECT user_id, period, target, is_gone_in_two, is_leaver, round({_MEAN}, 6) AS score FROM targets
)"""
_SCORED = (UD, DAYS, TARGETS, SCORED)
_RANKED = "row_number() OVER (ORDER BY score DESC, user_id, period)"
FLAGGED = "flagged AS (SELECT *, CASE WHEN score >= 0.25 THEN 1 ELSE 0 END AS contact FROM scored)"


def _profit(label: str = "is_gone_in_two") -> str:
    return f"CASE WHEN {label} = 1 THEN {fixed.GAIN_PER_HIT} ELSE -{fixed.COST_PER_MISS} END"


def _curve(partition: str = "") -> str:
    order = f"({partition} ORDER BY score DESC, user_id, period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""curve AS (
  SELECT user_id, period, score, is_gone_in_two,
    count(*) OVER {order} AS contacts, sum({_profit()}) OVER {order} AS profit
  FROM scored
)"""


def _scored_table(score: str, threshold: float) -> str:
    return (
        f"ranked AS (SELECT user_id, period, score, CASE WHEN score >= {threshold!r} THEN 1 ELSE 0 END AS contact,"
        f" {_RANKED} AS rank_desc FROM ({score}) s)"
    )


_ONE_MODEL = f"SELECT user_id, period, {_clip(_SCORES[0])} AS score FROM days WHERE period = {SCORED_DAY}"
_ENSEMBLE = f"SELECT user_id, period, score FROM scored WHERE period = {SCORED_DAY}"


def _hash(entity: str, seed: int) -> str:
    return f"md5(concat_ws('|', {entity}, period, {seed}))"


_UNDERSAMPLED = f"""counted AS (
  SELECT *, count(CASE WHEN target <> '{fixed.STAYS}' THEN 1 END) OVER () AS others,
    row_number() OVER (PARTITION BY target = '{fixed.STAYS}' ORDER BY {_hash('supplier_id', fixed.UNDERSAMPLE_SEED)}) AS place
  FROM labelled
), sampled AS (
  SELECT * FROM counted
  WHERE target <> '{fixed.STAYS}' OR place <= CAST(floor({fixed.UNDERSAMPLE_FACTOR} * others) AS BIGINT)
)"""
_FOLDED = f"""folded AS (
  SELECT user_id, period, is_leaver,
    (row_number() OVER (PARTITION BY is_leaver ORDER BY {_hash('user_id', fixed.FOLD_SEED)}) - 1) % {fixed.FOLDS} AS fold
  FROM targets
)"""
_NOISE = ", ".join(
    f"CAST(concat('0x', substr(md5(concat_ws('|', user_id, period, {fixed.FOLD_SEED}, {i})), 1, 13)) AS BIGINT) / 4503599627370496.0 AS canary_{i}"
    for i in range(1, fixed.CANARIES + 1)
)


def _noise_columns() -> tuple[str, str, str]:
    counts = "events n_view n_click n_error n_purchase n_signup"
    return f"user_id period {counts}", " ".join(["value_sum value_avg value_max", *[f"canary_{i}" for i in range(1, fixed.CANARIES + 1)]]), "target"


_LAST_DAYS = f"(SELECT DISTINCT period FROM days ORDER BY period DESC LIMIT {FUTURE_DAYS})"


_CARRIED_LAGS = ", ".join(f"lag({c}, {k}) OVER (PARTITION BY customer_id ORDER BY period) AS {c}_lag{k}" for c in ("activity", "tenure") for k in (1, 2))
_CARRIED_DELTAS = ", ".join(f"{c} - {c}_lag{k} AS {c}_d{k}" for c in ("activity", "tenure") for k in (1, 2))


def _rule_nodes() -> list[str]:
    """The ensemble of the rule as nested conditions."""
    seen = [f if f != "never_seen" else "0" for f in MODEL_FEATURES]
    cuts = ", ".join(f"floor(avg({x})) + 0.5 AS cut{i}" for i, x in enumerate(seen))
    trees = []
    for i, x in enumerate(seen):
        j = (i + 1) % len(seen)
        trees.append(f"{i + 1} * CASE WHEN {x} <= cut{i} THEN -0.05 WHEN {seen[j]} <= cut{j} THEN 0.02 ELSE 0.1 END")
    return [
        f"cuts AS (SELECT {cuts} FROM days)",
        f"raw_margin AS (SELECT user_id, period, CAST({' + '.join(trees)} AS DOUBLE) AS m FROM days, cuts)",
        """scored_nodes AS (SELECT user_id, period, model, 1 / (1 + exp(1.0 - m * (model + 1))) AS score
          FROM raw_margin, range(0, 2) AS r(model))""",
    ]


_RULE_NODES = _rule_nodes()


def oracle_sql() -> dict[str, str]:
    cm_key, sm_key, ud_key = "customer_id period", "supplier_id period", "user_id period"
    labelled_cm = _with(CM, _monthly("labelled", "cm", "customer_id")) + comparable_sql(
        "labelled", f"{cm_key} activity", others="target"
    )
    ema = _of_kind(_SMOOTH_DOUBLES, "_ema_")
    v3_columns = [*MEASURES, *GROUPS]
    long_columns = [*_LONG_LIST, *_LONG_GROUPS]
    double_columns = [*_MONEY_LIST, *_GROUP_DOUBLES]
    drift_all = (SM, LONG_FORM, PSI, DRIFT)
    rates_all = (SM, LONG_FORM, RATES, OUTLIERS)
    return {
        "panel_customer_month": _with(CM)
        + comparable_sql("cm", f"{cm_key} {_LONG_MEASURES}", _MONEY_MEASURES),
        "panel_supplier_month": _with(SM)
        + comparable_sql("sm", f"{sm_key} {_LONG_MEASURES}", _MONEY_MEASURES),
        "panel_user_day": _with(UD) + comparable_sql("ud", _UD_LONGS, "value_sum value_avg value_max"),
        "attrition_label": labelled_cm,
        "label_by_join": labelled_cm,
        "attrition_label_days": _with(UD, DAYS)
        + comparable_sql("days", f"{ud_key} events", others="target"),
        "targets_and_weights": _with(
            UD, DAYS, TARGETS,
            f"""weighted AS (SELECT *, CASE
              WHEN target = '{fixed.GONE_IN_TWO}' THEN {fixed.CLASS_WEIGHTS[fixed.GONE_IN_TWO]}
              WHEN target = '{fixed.GONE_NEXT}' THEN {fixed.CLASS_WEIGHTS[fixed.GONE_NEXT]}
              ELSE {fixed.OTHER_WEIGHT} END AS row_weight, 1.0 AS unit_weight FROM targets)""",
        )
        + comparable_sql(
            "weighted", f"{ud_key} is_gone_in_two is_leaver", "row_weight unit_weight", "target"
        ),
        "period_arithmetic": _with(
            CM,
            f"""moved AS (SELECT customer_id, period, {_add_months('period', 1)} AS next_period,
              {_add_months('period', 2)} AS second_period, {_add_months('period', -13)} AS year_ago,
              make_date(CAST(floor(period / 100) AS INTEGER), CAST(period % 100 AS INTEGER), 1) AS period_date
              FROM cm)""",
        )
        + comparable_sql("moved", f"{cm_key} next_period second_period year_ago", others="period_date"),
        "base_combos": _features(
            CM, "cm", CUSTOMER_MONTH, 1, f"{_LONG_MEASURES} count_total tx_count",
            f"{_MONEY_MEASURES} {_COMBO_DOUBLES}", "period_date",
        ),
        "sequence_features": _features(
            CM, "cm", CUSTOMER_MONTH, 1, _STEP1_LONGS, f"{_COMBO_DOUBLES} {_SEQUENCE_DOUBLES}",
            "period_date",
        ),
        "numeric_summary": _with(CM, _ranked("cm"), _steps(CUSTOMER_MONTH)[0],
                                 "summary AS (SELECT *, customer_id AS entity_id FROM step1_cards)")
        + comparable_sql(
            "summary",
            "entity_id period count_total tx_count history_index count_f count_o bulk_count sent_count",
            f"{_COMBO_DOUBLES} spend_f spend_o sent_amount received_amount",
            "period_date",
        ),
        "trend_features": _features(CM, "cm", CUSTOMER_MONTH, 1, "", _TREND_DOUBLES),
        "trend_features_supplier": _features(SM, "sm", SUPPLIER_MONTH, 1, "", _TREND_DOUBLES),
        "activity_rank_features": _features(
            SM, "sm", SUPPLIER_MONTH, 2, f"{_LONG_MEASURES} {_STEP2_LONGS}",
            f"{_MONEY_MEASURES} {_STEP2_DOUBLES}",
        ),
        "rolling_stats_joined": _features(
            SM, "sm", SUPPLIER_MONTH, 3, f"{_LONG_MEASURES} {_STEP3_LONGS}",
            f"{_MONEY_MEASURES} {_STEP3_DOUBLES}",
        ),
        "risk_features": _features(CM, "cm", CUSTOMER_MONTH, 4, _STEP4_LONGS, _STEP4_DOUBLES),
        "risk_joined_back": _features(
            CM, "cm", CUSTOMER_MONTH, 4, _STEP4_LONGS,
            f"tx_amount received_amount sent_amount utilisation {_STEP4_DOUBLES}",
        ).replace(
            "\nFROM step4_risk",
            "".join(
                f",\n  {rounded_sql(c)} AS {c}_risk"
                for c in ("received_amount", "sent_amount", "utilisation")
            )
            + "\nFROM step4_risk",
        ),
        "behaviour_features": _features(CM, "cm", CUSTOMER_MONTH, 5, _STEP5_LONGS, _STEP5_DOUBLES),
        "features_full": _full_features(),
        "features_full_sql": _full_features(),
        "group_sums": _with(SM, GS)
        + comparable_sql("gs", f"{sm_key} {' '.join(_LONG_GROUPS)}", " ".join(_GROUP_DOUBLES)),
        "lags_deltas_all": _with(SM, _generated(_lags(MEASURES), "sm"))
        + comparable_sql("made", f"{sm_key} {_lag_names(_LONG_LIST)}", _lag_names(_MONEY_LIST)),
        "ema": _with(SM, GS, RN, _generated(_SMOOTH_SQL, "rn")) + comparable_sql("made", sm_key, ema),
        "rolling_max_min": _with(SM, GS, RN, _generated(_SMOOTH_SQL, "rn"))
        + comparable_sql("made", f"{sm_key} {_SMOOTH_LONGS}", _of_kind(_SMOOTH_DOUBLES, "_win")),
        "features_v2": _with(SM, GS, _generated(_lags(v3_columns), "gs"))
        + comparable_sql(
            "made",
            f"{sm_key} {' '.join(long_columns)} {_lag_names(long_columns)}",
            f"{' '.join(double_columns)} {_lag_names(double_columns)}",
        ),
        "features_v3": _with(
            SM, GS, RN, _generated(_SMOOTH_SQL + _lags(v3_columns), "rn"),
            f"late AS (SELECT * FROM made WHERE period >= {FIRST_PERIOD})",
        )
        + comparable_sql(
            "late",
            f"{sm_key} {' '.join(long_columns)} {_lag_names(long_columns)} {_SMOOTH_LONGS}",
            f"{' '.join(double_columns)} {_lag_names(double_columns)} {_SMOOTH_DOUBLES}",
        ),
        "psi_cuts": _with(
            SM, LONG_FORM, PSI,
            """listed AS (SELECT col AS "column", unnest(range(1, len(cut) + 1)) AS position,
              unnest(cut) AS cut FROM cuts)""",
        )
        + comparable_sql("listed", "position", "cut", '"column"'),
        "iqr_bounds": _with(
            SM, LONG_FORM, RATES,
            'limits AS (SELECT col AS "column", lo AS low, hi AS high FROM bounds)',
        )
        + comparable_sql("limits", doubles="low high", others='"column"'),
        "psi_by_column_month": _with(SM, LONG_FORM, PSI) + comparable_sql("psi", "period", "psi", '"column"'),
        "psi_of_wide_panel": _with(
            SM, _generated(_lags(MEASURES, WIDE_STEPS), "sm"), _long_form([*MEASURES, *_WIDE], "made"), PSI
        )
        + comparable_sql("psi", "period", "psi", '"column"'),
        "drift_by_month": _with(*drift_all)
        + comparable_sql(
            "drift", "period columns_over_low columns_over_high", "avg_psi max_psi",
            "drift_flag period_date",
        ),
        "outlier_rate_by_column_month": _with(SM, LONG_FORM, RATES)
        + comparable_sql("rates", "period", "outlier_rate", '"column"'),
        "outlier_by_month": _with(*rates_all)
        + comparable_sql(
            "outliers", "period columns_over_low columns_over_high",
            "avg_outlier_rate max_outlier_rate", "outlier_flag period_date",
        ),
        "months_to_drop": _with(*drift_all, *rates_all[2:], BAD) + comparable_sql("bad", "period"),
        "panel_without_bad_months": _with(
            *drift_all, *rates_all[2:], BAD,
            "good AS (SELECT * FROM sm WHERE period NOT IN (SELECT period FROM bad))",
        )
        + comparable_sql("good", f"{sm_key} {_LONG_MEASURES}", _MONEY_MEASURES),
        "distinct_months": _with(CM, "months AS (SELECT DISTINCT period FROM cm)")
        + comparable_sql("months", "period"),
        "append_month_twice": _with(CM) + comparable_sql("cm", "customer_id period activity"),
        "new_month_lags": _with(
            CM,
            f"lagged AS (SELECT *, {_CARRIED_LAGS} FROM cm)",
            f"newest AS (SELECT *, {_CARRIED_DELTAS} FROM lagged WHERE period = (SELECT max(period) FROM cm))",
        )
        + comparable_sql("newest", "customer_id period activity tenure " + " ".join(f"{c}_{x}{k}" for c in ("activity", "tenure") for x in ("lag", "d") for k in (1, 2))),
        "csv_round_trip": _with(
            UD,
            """daily AS (SELECT period, count(*) AS n, sum(events) AS events, sum(user_id) AS ids,
              count(*) FILTER (WHERE user_id % 10 = 0) AS malformed FROM ud GROUP BY period)""",
        )
        + comparable_sql("daily", "period n events ids malformed"),
        "bucketed_join": _with(CM, "summed AS (SELECT *, sum(activity) OVER (PARTITION BY customer_id ORDER BY period) AS activity_so_far FROM cm)")
        + comparable_sql("summed", "customer_id period activity tenure activity_so_far"),
        "customers_in_both_months": _with(
            CM, "both_months AS (SELECT customer_id FROM cm WHERE period = 199701 INTERSECT SELECT customer_id FROM cm WHERE period = 199702)"
        )
        + comparable_sql("both_months", "customer_id"),
        "customers_only_in_month": _with(
            CM, "one_month AS (SELECT customer_id FROM cm WHERE period = 199701 EXCEPT SELECT customer_id FROM cm WHERE period = 199702)"
        )
        + comparable_sql("one_month", "customer_id"),
        "sketch_quantiles": _with(
            SM, LONG_FORM,
            """wanted AS (SELECT col AS "column", unnest([0.1, 0.25, 0.5, 0.75, 0.9]) AS probability, n
              FROM (SELECT col, count(v) AS n FROM vals GROUP BY col)), told AS (SELECT *, true AS within_bound FROM wanted)""",
        )
        + comparable_sql("told", "n", "probability", '"column" within_bound'),
        "node_table_scores": _with(UD, DAYS, *_RULE_NODES) + comparable_sql("scored_nodes", "user_id period model", "score"),
        "append_snapshot_month": _with(
            CM,
            "latest AS (SELECT max(period) AS last FROM cm)",
            """whole AS (SELECT cm.* FROM cm, latest WHERE period < last
              UNION ALL SELECT cm.* FROM cm, latest WHERE period = last)""",
        )
        + comparable_sql("whole", f"{cm_key} {_LONG_MEASURES}", _MONEY_MEASURES),
        "train_future_split": _with(
            UD, DAYS,
            f"""parts AS (SELECT *, CASE WHEN period IN {_LAST_DAYS} THEN 'future' ELSE 'train' END AS part
              FROM days)""",
        )
        + comparable_sql("parts", f"{ud_key} events", others="target part"),
        "undersample_majority": _with(SM, _monthly("labelled", "sm", "supplier_id"), _UNDERSAMPLED)
        + comparable_sql("sampled", f"{sm_key} activity", "spend_f", "target"),
        "filter_class": _with(UD, DAYS, f"others AS (SELECT * FROM days WHERE target <> '{fixed.STAYS}')")
        + comparable_sql("others", f"{ud_key} events", others="target"),
        "stratified_folds": _with(UD, DAYS, TARGETS, _FOLDED)
        + comparable_sql("folded", f"{ud_key} is_leaver fold"),
        "folds_missing_label": _with(
            UD, DAYS, TARGETS.replace("targets AS", "all_targets AS"),
            "targets AS (SELECT user_id, period, CASE WHEN user_id % 5 <> 0 THEN is_leaver END AS is_leaver FROM all_targets)",
            _FOLDED,
        )
        + comparable_sql("folded", f"{ud_key} is_leaver fold"),
        "canary_columns": _with(UD, DAYS, f"noise AS (SELECT {_NOISE}, * FROM days)")
        + comparable_sql("noise", *_noise_columns()),
        "aligned_matrix": _with(UD, "matrix AS (SELECT *, 0.0 AS never_seen FROM ud)")
        + comparable_sql(
            "matrix", f"{ud_key} events n_error n_purchase", "value_sum value_max never_seen"
        ),
        "score_month": _with(UD, DAYS, _scored_table(_ONE_MODEL, fixed.DECISION_THRESHOLD))
        + comparable_sql("ranked", f"{ud_key} contact rank_desc", "score"),
        "score_month_ensemble": _with(*_SCORED, _scored_table(_ENSEMBLE, fixed.DECISION_THRESHOLD))
        + comparable_sql("ranked", f"{ud_key} contact rank_desc", "score"),
        "score_all_days": _with(
            *_SCORED,
            """ranked AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY score DESC, user_id)
              AS rank_desc FROM scored)""",
        )
        + comparable_sql("ranked", f"{ud_key} rank_desc", "score"),
        "head_report": _with(
            *_SCORED, "top AS (SELECT * FROM scored ORDER BY score DESC, user_id, period LIMIT 10)"
        )
        + comparable_sql("top", ud_key, "score"),
        "top_n_flag": _with(
            *_SCORED,
            f"top AS (SELECT *, CASE WHEN {_RANKED} <= {TOP_N} THEN 1 ELSE 0 END AS contact FROM scored)",
        )
        + comparable_sql("top", f"{ud_key} contact", "score"),
        "top_n_missing_scores": _with(
            *_SCORED,
            f"""top AS (SELECT user_id, period, CASE WHEN row_number() OVER (
                ORDER BY user_id % 3 <> 2, user_id % 3 = 0, CASE WHEN user_id % 3 = 2 THEN score END DESC, user_id, period)
              <= count(*) FILTER (WHERE user_id % 3 = 2 AND score IS NOT NULL) OVER () + {TOP_N} THEN 1 ELSE 0 END AS contact
              FROM scored)""",
        )
        + comparable_sql("top", f"{ud_key} contact"),
        "rank_wide_keys": _with(
            """keyed AS (SELECT concat('order-', o_orderkey) AS id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
              4611686018427387904 + o_orderkey % 1000 AS wide_key FROM orders)""",
            "ranked AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY wide_key DESC, id) AS rank_desc FROM keyed)",
        )
        + comparable_sql("ranked", "wide_key rank_desc", others="id status"),
        "simple_export": _with(
            *_SCORED, _scored_table(_ENSEMBLE, fixed.DECISION_THRESHOLD),
            'listed AS (SELECT user_id, contact AS "Predicted" FROM ranked)',
        )
        + comparable_sql("listed", 'user_id "Predicted"'),
        "profit_curve": _with(*_SCORED, _curve())
        + comparable_sql("curve", f"{ud_key} is_gone_in_two contacts profit", "score"),
        "profit_curve_max": _with(*_SCORED, _curve(), "best AS (SELECT max(profit) AS max_profit FROM curve)")
        + comparable_sql("best", "max_profit"),
        "profit_argmax": _with(
            *_SCORED, _curve("PARTITION BY period"),
            """best AS (SELECT c.period, max_profit, min(contacts) AS best_contacts
              FROM curve c JOIN (SELECT period, max(profit) AS max_profit FROM curve GROUP BY period) m
                ON c.period = m.period AND c.profit = m.max_profit GROUP BY c.period, max_profit)""",
        )
        + comparable_sql("best", "period max_profit best_contacts"),
        "profit_top_n": _with(
            *_SCORED,
            f"top AS (SELECT * FROM scored ORDER BY score DESC, user_id, period LIMIT {TOP_N})",
            f"total AS (SELECT count(*) AS contacts, sum({_profit()}) AS profit FROM top)",
        )
        + comparable_sql("total", "contacts profit"),
        "profit_threshold": _with(
            *_SCORED, FLAGGED,
            f"total AS (SELECT sum({_profit('is_leaver')}) AS profit FROM flagged WHERE contact = 1)",
        )
        + comparable_sql("total", "profit"),
        "profit_no_truth": _with(
            *_SCORED, FLAGGED,
            f"total AS (SELECT -{fixed.COST_PER_MISS} * sum(contact) AS profit FROM flagged)",
        )
        + comparable_sql("total", "profit"),
        "confusion_matrix": _with(
            *_SCORED, FLAGGED,
            """grid AS (SELECT a.actual, p.predicted FROM (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted))""",
            """cells AS (SELECT g.actual, g.predicted, count(f.user_id) AS n FROM grid g
              LEFT JOIN flagged f ON f.is_leaver = g.actual AND f.contact = g.predicted
              GROUP BY g.actual, g.predicted)""",
        )
        + comparable_sql("cells", "actual predicted n"),
        "log_loss": _with(
            *_SCORED,
            f"""loss AS (SELECT -avg(is_leaver * ln({_clip('score')})
              + (1 - is_leaver) * ln(1 - {_clip('score')})) AS log_loss FROM scored)""",
        )
        + comparable_sql("loss", doubles="log_loss"),
        "coverage": _with(
            *_SCORED, FLAGGED,
            """covered AS (SELECT sum(contact) AS contacted, count(*) AS total,
              100.0 * CAST(sum(contact) AS DOUBLE) / count(*) AS percent FROM flagged)""",
        )
        + comparable_sql("covered", "contacted total", "percent"),
        "join_truth_pred_inner": _with(
            *_SCORED, FLAGGED,
            f"""joined AS (SELECT t.user_id, t.is_gone_in_two, f.contact FROM scored t
              JOIN flagged f ON t.user_id = f.user_id
              WHERE t.period = {SCORED_DAY} AND f.period = {SCORED_DAY})""",
        )
        + comparable_sql("joined", "user_id is_gone_in_two contact"),
        "join_pred_truth_left": _with(
            *_SCORED,
            f"""joined AS (SELECT p.user_id, p.period, p.score, coalesce(t.is_gone_in_two, 0) AS is_gone_in_two
              FROM scored p LEFT JOIN (SELECT * FROM scored WHERE period NOT IN {_LAST_DAYS}) t
              ON p.user_id = t.user_id AND p.period = t.period)""",
        )
        + comparable_sql("joined", f"{ud_key} is_gone_in_two", "score"),
        "train_matrix": _with(
            UD, DAYS, TARGETS,
            f"""matrix AS (SELECT *, CAST(is_leaver AS DOUBLE) AS label, is_gone_in_two AS campaign_hit,
              CASE WHEN target = '{fixed.GONE_IN_TWO}' THEN {fixed.CLASS_WEIGHTS[fixed.GONE_IN_TWO]}
                   WHEN target = '{fixed.GONE_NEXT}' THEN {fixed.CLASS_WEIGHTS[fixed.GONE_NEXT]}
                   ELSE {fixed.OTHER_WEIGHT} END AS weight
              FROM targets WHERE period NOT IN {_LAST_DAYS})""",
        )
        + comparable_sql(
            "matrix", f"{ud_key} campaign_hit", "label weight " + " ".join(USER_MEASURES)
        ),
    }
