SELECT
  *,
  coalesce({balance_a}, 0) + coalesce({balance_b}, 0) AS balance_total,
  lag({activity}, 1) OVER hist AS activity_lag1,
  lag({activity}, 2) OVER hist AS activity_lag2,
  lag({activity}, 3) OVER hist AS activity_lag3,
  avg({activity}) OVER last4 AS activity_avg4,
  {activity} - lag({activity}, 1) OVER hist AS activity_delta1,
  {activity} - lag({activity}, 2) OVER hist AS activity_delta2
FROM step1_cards
WINDOW
  hist AS (PARTITION BY {id_col} ORDER BY {period_col}),
  last4 AS (PARTITION BY {id_col} ORDER BY {period_col} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
