SELECT
  *,
  lag(spend_total) OVER hist AS spend_lag1,
  lag(count_total) OVER hist AS count_lag1,
  lag(tx_amount) OVER hist AS tx_amount_lag1,
  lag(tx_count) OVER hist AS tx_count_lag1,
  spend_total - lag(spend_total) OVER hist AS spend_delta1,
  count_total - lag(count_total) OVER hist AS count_delta1,
  CASE WHEN abs(lag(spend_total) OVER hist) > 1e-12
       THEN (spend_total - lag(spend_total) OVER hist) / abs(lag(spend_total) OVER hist)
  END AS spend_growth,
  avg(spend_total) OVER last1 AS spend_avg1,
  avg(spend_total) OVER last2 AS spend_avg2,
  avg(spend_total) OVER last3 AS spend_avg3,
  avg(count_total) OVER last3 AS count_avg3,
  sum(tx_count) OVER last3 AS tx_count_sum3,
  min(tx_amount) OVER last3 AS tx_amount_min3,
  max(tx_amount) OVER last3 AS tx_amount_max3,
  CASE WHEN limit_total > 0 THEN CAST(spend_total AS DOUBLE) / limit_total
       ELSE CAST(0 AS DOUBLE) END AS utilisation,
  CASE WHEN count_total > 0 THEN CAST(spend_total AS DOUBLE) / count_total END AS mean_ticket,
  sum(spend_total) OVER so_far AS spend_to_date,
  sum(count_total) OVER so_far AS count_to_date,
  lag({spend_a}) OVER hist AS spend_a_lag1,
  lag({spend_b}) OVER hist AS spend_b_lag1,
  {spend_a} - lag({spend_a}) OVER hist AS spend_a_delta1,
  {spend_b} - lag({spend_b}) OVER hist AS spend_b_delta1,
  CASE WHEN history_index > 1 THEN
    regr_slope(spend_total, history_index) OVER so_far END AS spend_slope,
  CASE WHEN history_index > 1 THEN
    regr_intercept(spend_total, history_index) OVER so_far END AS spend_intercept
FROM (
  SELECT
    *,
    make_date(CAST(floor({period_col} / 100) AS INT), CAST({period_col} % 100 AS INT), 1) AS period_date,
    coalesce({spend_a}, 0) + coalesce({spend_b}, 0) AS spend_total,
    coalesce({count_a}, 0) + coalesce({count_b}, 0) AS count_total,
    coalesce({limit_a}, 0) + coalesce({limit_b}, 0) AS limit_total,
    coalesce({count_a}, 0) + coalesce({count_b}, 0) + coalesce({sent_count}, 0)
      + coalesce({cash_count}, 0) AS tx_count,
    coalesce({spend_a}, 0) + coalesce({spend_b}, 0) + coalesce({sent_amount}, 0)
      + coalesce({received_amount}, 0) AS tx_amount,
    row_number() OVER (PARTITION BY {id_col} ORDER BY {period_col}) AS history_index
  FROM {base_table}
) combos
WINDOW
  hist AS (PARTITION BY {id_col} ORDER BY {period_col}),
  last1 AS (PARTITION BY {id_col} ORDER BY {period_col} ROWS BETWEEN CURRENT ROW AND CURRENT ROW),
  last2 AS (PARTITION BY {id_col} ORDER BY {period_col} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW),
  last3 AS (PARTITION BY {id_col} ORDER BY {period_col} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
  so_far AS (PARTITION BY {id_col} ORDER BY {period_col}
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
