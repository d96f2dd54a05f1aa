SELECT
  *,
  CASE WHEN abs(activity_lag1) > 1e-12
       THEN CAST({activity} - activity_lag1 AS DOUBLE) / abs(activity_lag1)
  END AS activity_drop_share,
  CASE WHEN activity_lag1 > 0 AND {activity} < 0.5 * activity_lag1 THEN 1 ELSE 0 END AS flag_activity_drop,
  CASE WHEN activity_delta1 < 0 AND activity_delta2 < 0 THEN 1 ELSE 0 END AS flag_two_periods_down,
  CASE WHEN {activity} <= 3 AND coalesce(activity_lag1, 0) > 3 THEN 1 ELSE 0 END AS flag_near_inactive,
  CASE WHEN utilisation > 0.8 THEN 1 ELSE 0 END AS flag_high_utilisation,
  CASE WHEN mean_ticket < 2000 AND tx_count > 20 THEN 1 ELSE 0 END AS flag_small_ticket_often,
  tx_amount_max3 - tx_amount_min3 AS tx_amount_range3,
  CASE WHEN abs(tx_amount_max3) > 1e-12
       THEN (tx_amount_max3 - tx_amount_min3) / abs(tx_amount_max3)
  END AS tx_amount_relative_range3,
  {received_amount} - lag({received_amount}) OVER hist AS received_delta1,
  CASE WHEN lag({received_amount}) OVER hist > 0
        AND {received_amount} < 0.5 * lag({received_amount}) OVER hist
       THEN 1 ELSE 0 END AS flag_income_drop,
  CASE WHEN {tenure} > 0 THEN CAST({activity} AS DOUBLE) / {tenure} END AS activity_per_tenure,
  CASE WHEN {tenure} >= 24 AND {activity} <= 3 THEN 1 ELSE 0 END AS flag_old_low_use,
  CASE WHEN spend_slope < 0 THEN 1 ELSE 0 END AS flag_spend_falling
FROM step3_rolling
WINDOW hist AS (PARTITION BY {id_col} ORDER BY {period_col})
