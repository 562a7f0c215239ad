, goods AS (SELECT i_item_sk AS good, i_brand_id, i_class_id, i_category_id, i_manufact_id FROM item WHERE i_category = '$category'),
days AS (SELECT d_date_sk AS day, d_year AS yr FROM date_dim WHERE d_year BETWEEN $year - 1 AND $year),
by_catalog AS (
  SELECT yr, goods.* EXCLUDE (good), cs_quantity - coalesce(cr_return_quantity, 0) AS n,
         cs_ext_sales_price - coalesce(cr_return_amount, 0.0) AS v
  FROM catalog_sales JOIN days ON cs_sold_date_sk = day JOIN goods ON cs_item_sk = good
  LEFT JOIN catalog_returns ON cr_item_sk = cs_item_sk AND cr_order_number = cs_order_number),
by_store AS (
  SELECT yr, goods.* EXCLUDE (good), ss_quantity - coalesce(sr_return_quantity, 0) AS n,
         ss_ext_sales_price - coalesce(sr_return_amt, 0.0) AS v
  FROM store_sales JOIN days ON ss_sold_date_sk = day JOIN goods ON ss_item_sk = good
  LEFT JOIN store_returns ON sr_item_sk = ss_item_sk AND sr_ticket_number = ss_ticket_number),
by_web AS (
  SELECT yr, goods.* EXCLUDE (good), ws_quantity - coalesce(wr_return_quantity, 0) AS n,
         ws_ext_sales_price - coalesce(wr_return_amt, 0.0) AS v
  FROM web_sales JOIN days ON ws_sold_date_sk = day JOIN goods ON ws_item_sk = good
  LEFT JOIN web_returns ON wr_item_sk = ws_item_sk AND wr_order_number = ws_order_number),
-- a row that occurs again, in this or another channel, counts once
net AS (SELECT DISTINCT * FROM (FROM by_catalog UNION ALL FROM by_store UNION ALL FROM by_web)),
product AS (
  SELECT i_brand_id, i_class_id, i_category_id, i_manufact_id,
         sum(n) FILTER (yr < $year) AS n0, sum(n) FILTER (yr = $year) AS n1,
         sum(v) FILTER (yr < $year) AS v0, sum(v) FILTER (yr = $year) AS v1
  FROM net GROUP BY ALL)
SELECT $year - 1 AS prev_year, $year AS year, i_brand_id, i_class_id, i_category_id, i_manufact_id,
       CAST(n0 AS BIGINT) AS prev_yr_cnt, CAST(n1 AS BIGINT) AS curr_yr_cnt, CAST(n1 - n0 AS BIGINT) AS sales_cnt_diff,
       CAST(v1 - v0 AS DECIMAL(38,2)) AS sales_amt_diff
FROM product WHERE n0 > 0 AND 10 * n1 < 9 * n0
ORDER BY sales_cnt_diff, prev_year, year, i_brand_id, i_class_id, i_category_id, i_manufact_id, prev_yr_cnt, curr_yr_cnt, sales_amt_diff
LIMIT 100
