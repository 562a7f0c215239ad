SELECT w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, ship_carriers, year,
       CAST(sum(jan_sales) AS DECIMAL(38,2)) AS jan_sales,
       CAST(sum(feb_sales) AS DECIMAL(38,2)) AS feb_sales,
       CAST(sum(mar_sales) AS DECIMAL(38,2)) AS mar_sales,
       CAST(sum(apr_sales) AS DECIMAL(38,2)) AS apr_sales,
       CAST(sum(may_sales) AS DECIMAL(38,2)) AS may_sales,
       CAST(sum(jun_sales) AS DECIMAL(38,2)) AS jun_sales,
       CAST(sum(jul_sales) AS DECIMAL(38,2)) AS jul_sales,
       CAST(sum(aug_sales) AS DECIMAL(38,2)) AS aug_sales,
       CAST(sum(sep_sales) AS DECIMAL(38,2)) AS sep_sales,
       CAST(sum(oct_sales) AS DECIMAL(38,2)) AS oct_sales,
       CAST(sum(nov_sales) AS DECIMAL(38,2)) AS nov_sales,
       CAST(sum(dec_sales) AS DECIMAL(38,2)) AS dec_sales,
       round(CAST(sum(jan_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS jan_sales_per_sq_foot,
       round(CAST(sum(feb_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS feb_sales_per_sq_foot,
       round(CAST(sum(mar_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS mar_sales_per_sq_foot,
       round(CAST(sum(apr_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS apr_sales_per_sq_foot,
       round(CAST(sum(may_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS may_sales_per_sq_foot,
       round(CAST(sum(jun_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS jun_sales_per_sq_foot,
       round(CAST(sum(jul_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS jul_sales_per_sq_foot,
       round(CAST(sum(aug_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS aug_sales_per_sq_foot,
       round(CAST(sum(sep_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS sep_sales_per_sq_foot,
       round(CAST(sum(oct_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS oct_sales_per_sq_foot,
       round(CAST(sum(nov_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS nov_sales_per_sq_foot,
       round(CAST(sum(dec_sales / w_warehouse_sq_ft) AS DOUBLE), 4) AS dec_sales_per_sq_foot,
       CAST(sum(jan_net) AS DECIMAL(38,2)) AS jan_net,
       CAST(sum(feb_net) AS DECIMAL(38,2)) AS feb_net,
       CAST(sum(mar_net) AS DECIMAL(38,2)) AS mar_net,
       CAST(sum(apr_net) AS DECIMAL(38,2)) AS apr_net,
       CAST(sum(may_net) AS DECIMAL(38,2)) AS may_net,
       CAST(sum(jun_net) AS DECIMAL(38,2)) AS jun_net,
       CAST(sum(jul_net) AS DECIMAL(38,2)) AS jul_net,
       CAST(sum(aug_net) AS DECIMAL(38,2)) AS aug_net,
       CAST(sum(sep_net) AS DECIMAL(38,2)) AS sep_net,
       CAST(sum(oct_net) AS DECIMAL(38,2)) AS oct_net,
       CAST(sum(nov_net) AS DECIMAL(38,2)) AS nov_net,
       CAST(sum(dec_net) AS DECIMAL(38,2)) AS dec_net
FROM ((SELECT w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, '$carrier1' || ',' || '$carrier2' AS ship_carriers, d_year AS year,
  sum(CASE WHEN d_moy = 1 THEN ws_sales_price * ws_quantity ELSE 0 END) AS jan_sales,
  sum(CASE WHEN d_moy = 2 THEN ws_sales_price * ws_quantity ELSE 0 END) AS feb_sales,
  sum(CASE WHEN d_moy = 3 THEN ws_sales_price * ws_quantity ELSE 0 END) AS mar_sales,
  sum(CASE WHEN d_moy = 4 THEN ws_sales_price * ws_quantity ELSE 0 END) AS apr_sales,
  sum(CASE WHEN d_moy = 5 THEN ws_sales_price * ws_quantity ELSE 0 END) AS may_sales,
  sum(CASE WHEN d_moy = 6 THEN ws_sales_price * ws_quantity ELSE 0 END) AS jun_sales,
  sum(CASE WHEN d_moy = 7 THEN ws_sales_price * ws_quantity ELSE 0 END) AS jul_sales,
  sum(CASE WHEN d_moy = 8 THEN ws_sales_price * ws_quantity ELSE 0 END) AS aug_sales,
  sum(CASE WHEN d_moy = 9 THEN ws_sales_price * ws_quantity ELSE 0 END) AS sep_sales,
  sum(CASE WHEN d_moy = 10 THEN ws_sales_price * ws_quantity ELSE 0 END) AS oct_sales,
  sum(CASE WHEN d_moy = 11 THEN ws_sales_price * ws_quantity ELSE 0 END) AS nov_sales,
  sum(CASE WHEN d_moy = 12 THEN ws_sales_price * ws_quantity ELSE 0 END) AS dec_sales,
  sum(CASE WHEN d_moy = 1 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS jan_net,
  sum(CASE WHEN d_moy = 2 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS feb_net,
  sum(CASE WHEN d_moy = 3 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS mar_net,
  sum(CASE WHEN d_moy = 4 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS apr_net,
  sum(CASE WHEN d_moy = 5 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS may_net,
  sum(CASE WHEN d_moy = 6 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS jun_net,
  sum(CASE WHEN d_moy = 7 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS jul_net,
  sum(CASE WHEN d_moy = 8 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS aug_net,
  sum(CASE WHEN d_moy = 9 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS sep_net,
  sum(CASE WHEN d_moy = 10 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS oct_net,
  sum(CASE WHEN d_moy = 11 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS nov_net,
  sum(CASE WHEN d_moy = 12 THEN ws_net_paid_inc_tax * ws_quantity ELSE 0 END) AS dec_net
 FROM web_sales, warehouse, date_dim, time_dim, ship_mode
 WHERE ws_warehouse_sk = w_warehouse_sk AND ws_sold_date_sk = d_date_sk AND ws_sold_time_sk = t_time_sk
   AND ws_ship_mode_sk = sm_ship_mode_sk AND d_year = $year AND t_time BETWEEN $time_lo AND $time_lo + 28800
   AND sm_carrier IN ('$carrier1', '$carrier2')
 GROUP BY w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, d_year)
      UNION ALL
      (SELECT w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, '$carrier1' || ',' || '$carrier2' AS ship_carriers, d_year AS year,
  sum(CASE WHEN d_moy = 1 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS jan_sales,
  sum(CASE WHEN d_moy = 2 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS feb_sales,
  sum(CASE WHEN d_moy = 3 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS mar_sales,
  sum(CASE WHEN d_moy = 4 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS apr_sales,
  sum(CASE WHEN d_moy = 5 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS may_sales,
  sum(CASE WHEN d_moy = 6 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS jun_sales,
  sum(CASE WHEN d_moy = 7 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS jul_sales,
  sum(CASE WHEN d_moy = 8 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS aug_sales,
  sum(CASE WHEN d_moy = 9 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS sep_sales,
  sum(CASE WHEN d_moy = 10 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS oct_sales,
  sum(CASE WHEN d_moy = 11 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS nov_sales,
  sum(CASE WHEN d_moy = 12 THEN cs_ext_sales_price * cs_quantity ELSE 0 END) AS dec_sales,
  sum(CASE WHEN d_moy = 1 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS jan_net,
  sum(CASE WHEN d_moy = 2 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS feb_net,
  sum(CASE WHEN d_moy = 3 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS mar_net,
  sum(CASE WHEN d_moy = 4 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS apr_net,
  sum(CASE WHEN d_moy = 5 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS may_net,
  sum(CASE WHEN d_moy = 6 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS jun_net,
  sum(CASE WHEN d_moy = 7 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS jul_net,
  sum(CASE WHEN d_moy = 8 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS aug_net,
  sum(CASE WHEN d_moy = 9 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS sep_net,
  sum(CASE WHEN d_moy = 10 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS oct_net,
  sum(CASE WHEN d_moy = 11 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS nov_net,
  sum(CASE WHEN d_moy = 12 THEN cs_net_paid_inc_ship_tax * cs_quantity ELSE 0 END) AS dec_net
 FROM catalog_sales, warehouse, date_dim, time_dim, ship_mode
 WHERE cs_warehouse_sk = w_warehouse_sk AND cs_sold_date_sk = d_date_sk AND cs_sold_time_sk = t_time_sk
   AND cs_ship_mode_sk = sm_ship_mode_sk AND d_year = $year AND t_time BETWEEN $time_lo AND $time_lo + 28800
   AND sm_carrier IN ('$carrier1', '$carrier2')
 GROUP BY w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, d_year)) x
GROUP BY w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, ship_carriers, year
ORDER BY w_warehouse_name NULLS LAST, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, ship_carriers, year, jan_sales, feb_sales, mar_sales, apr_sales, may_sales, jun_sales, jul_sales, aug_sales, sep_sales, oct_sales, nov_sales, dec_sales, jan_sales_per_sq_foot, feb_sales_per_sq_foot, mar_sales_per_sq_foot, apr_sales_per_sq_foot, may_sales_per_sq_foot, jun_sales_per_sq_foot, jul_sales_per_sq_foot, aug_sales_per_sq_foot, sep_sales_per_sq_foot, oct_sales_per_sq_foot, nov_sales_per_sq_foot, dec_sales_per_sq_foot, jan_net, feb_net, mar_net, apr_net, may_net, jun_net, jul_net, aug_net, sep_net, oct_net, nov_net, dec_net
LIMIT 100
