SELECT
  *,
  avg({activity}) OVER four AS activity_mean4,
  max({activity}) OVER four AS activity_max4,
  min({activity}) OVER four AS activity_min4,
  CASE WHEN history_index > 1 THEN regr_slope({activity}, {tenure}) OVER four END AS activity_slope4
FROM step2_activity
WINDOW four AS (PARTITION BY {id_col} ORDER BY {period_col} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
