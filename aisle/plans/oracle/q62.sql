SELECT substr(w_warehouse_name, 1, 20) AS wh_name, sm_type, web_name,
  CAST(sum(CASE WHEN ws_ship_date_sk - ws_sold_date_sk <= 30 THEN 1 ELSE 0 END) AS BIGINT) AS "30 days",
  CAST(sum(CASE WHEN ws_ship_date_sk - ws_sold_date_sk > 30 AND ws_ship_date_sk - ws_sold_date_sk <= 60
           THEN 1 ELSE 0 END) AS BIGINT) AS "31-60 days",
  CAST(sum(CASE WHEN ws_ship_date_sk - ws_sold_date_sk > 60 AND ws_ship_date_sk - ws_sold_date_sk <= 90
           THEN 1 ELSE 0 END) AS BIGINT) AS "61-90 days",
  CAST(sum(CASE WHEN ws_ship_date_sk - ws_sold_date_sk > 90 AND ws_ship_date_sk - ws_sold_date_sk <= 120
           THEN 1 ELSE 0 END) AS BIGINT) AS "91-120 days",
  CAST(sum(CASE WHEN ws_ship_date_sk - ws_sold_date_sk > 120 THEN 1 ELSE 0 END) AS BIGINT) AS ">120 days"
FROM web_sales
JOIN warehouse ON ws_warehouse_sk = w_warehouse_sk
JOIN ship_mode ON ws_ship_mode_sk = sm_ship_mode_sk
JOIN web_site ON ws_web_site_sk = web_site_sk
JOIN date_dim ON ws_ship_date_sk = d_date_sk
WHERE d_month_seq BETWEEN $month_seq AND $month_seq + 11
GROUP BY substr(w_warehouse_name, 1, 20), sm_type, web_name
ORDER BY wh_name NULLS LAST, sm_type NULLS LAST, web_name NULLS LAST,
         "30 days", "31-60 days", "61-90 days", "91-120 days", ">120 days"
LIMIT 100
