, monthly AS (
  SELECT i_category, i_brand, s_store_name, s_company_name, d_year, d_moy, CAST(sum(ss_sales_price) AS DECIMAL(38,2)) AS s
  FROM store_sales JOIN store ON s_store_sk = ss_store_sk JOIN item ON i_item_sk = ss_item_sk
  JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year * 12 + d_moy BETWEEN $year * 12 AND $year * 12 + 13
  GROUP BY ALL),
beside AS (
  SELECT *, CAST(sum(s) OVER in_year AS DOUBLE) / count(s) OVER in_year AS a, round(CAST(sum(s) OVER in_year * 10000 AS DOUBLE) / count(s) OVER in_year) / 10000 AS a4,
         lag(s) OVER months AS before, lead(s) OVER months AS after
  FROM monthly
  WINDOW in_year AS (PARTITION BY i_category, i_brand, s_store_name, s_company_name, d_year),
         months AS (PARTITION BY i_category, i_brand, s_store_name, s_company_name ORDER BY d_year, d_moy)),
picked AS (
  SELECT * FROM beside
  WHERE d_year = $year AND before IS NOT NULL AND after IS NOT NULL AND a > 0 AND abs(CAST(s AS DOUBLE) - a) / a > 0.1
  ORDER BY CAST(s AS DOUBLE) - a, d_moy, i_category, d_year, s, before, after LIMIT 100)
SELECT i_category, d_year, d_moy, a4 AS avg_monthly_sales, s AS sum_sales, before AS psum, after AS nsum FROM picked
