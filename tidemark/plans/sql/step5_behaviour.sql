SELECT
  *,
  CASE WHEN activity_max_to_date > 0 THEN CAST({activity} AS DOUBLE) / activity_max_to_date END AS activity_vs_best,
  CASE WHEN spend_avg_to_date > 0 THEN CAST(spend_total AS DOUBLE) / spend_avg_to_date END AS spend_vs_usual,
  CASE WHEN low_activity_count3 >= 3 THEN 1 ELSE 0 END AS flag_long_inactive,
  CASE WHEN activity_avg3 > 0 THEN activity_std3 / activity_avg3 END AS activity_cv3,
  CASE WHEN spend_mean3 > 0 THEN spend_std3 / spend_mean3 END AS spend_cv3
FROM (
  SELECT
    *,
    lag(utilisation) OVER hist AS utilisation_before,
    lag(mean_ticket) OVER hist AS mean_ticket_before,
    lag(tx_count) OVER hist AS tx_count_before,
    lag({activity}) OVER hist AS activity_before,
    lag(spend_total) OVER hist AS spend_before,
    lag(spend_to_date) OVER hist AS total_before,
    utilisation - lag(utilisation) OVER hist AS utilisation_change,
    mean_ticket - lag(mean_ticket) OVER hist AS mean_ticket_change,
    tx_count - lag(tx_count) OVER hist AS tx_count_change,
    {activity} - lag({activity}) OVER hist AS activity_change,
    spend_total - lag(spend_total) OVER hist AS spend_change,
    spend_to_date - lag(spend_to_date) OVER hist AS total_change,
    max({activity}) OVER so_far AS activity_max_to_date,
    avg({activity}) OVER so_far AS activity_avg_to_date,
    avg(spend_total) OVER so_far AS spend_avg_to_date,
    stddev_samp({activity}) OVER three AS activity_std3,
    avg({activity}) OVER three AS activity_avg3,
    stddev_samp(spend_total) OVER three AS spend_std3,
    avg(spend_total) OVER three AS spend_mean3,
    sum(CASE WHEN {activity} < 3 THEN 1 ELSE 0 END) OVER three AS low_activity_count3,
    sum(CASE WHEN {received_amount} IS NULL OR {received_amount} = 0 THEN 1 ELSE 0 END)
      OVER three AS no_income_count3,
    CASE WHEN {sent_amount} > 0 THEN CAST({received_amount} AS DOUBLE) / {sent_amount} END AS received_per_sent,
    CASE WHEN limit_total > 0 THEN CAST(balance_total AS DOUBLE) / limit_total END AS balance_per_limit,
    CASE WHEN limit_total > 0 AND CAST(balance_total AS DOUBLE) / limit_total > 0.95
         THEN 1 ELSE 0 END AS flag_credit_maxed,
    CASE WHEN tx_count > 0 THEN CAST(spend_total AS DOUBLE) / tx_count END AS spend_per_tx,
    CASE WHEN {activity} > 0 THEN CAST(spend_total AS DOUBLE) / {activity} END AS spend_per_activity,
    CASE WHEN spend_to_date > 0 THEN CAST(spend_total AS DOUBLE) / spend_to_date END AS spend_per_total,
    CASE WHEN {tenure} < 6 THEN 1 ELSE 0 END AS flag_recent,
    CASE WHEN {tenure} >= 24 AND {activity} <= 3 THEN 1 ELSE 0 END AS flag_veteran_idle
  FROM step4_risk
  WINDOW
    hist AS (PARTITION BY {id_col} ORDER BY {period_col}),
    so_far AS (PARTITION BY {id_col} ORDER BY {period_col}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    three AS (PARTITION BY {id_col} ORDER BY {period_col} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
) moved
