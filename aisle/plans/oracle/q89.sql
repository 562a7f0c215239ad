, choice AS (SELECT i_item_sk AS good, i_category, i_class, i_brand FROM item
             WHERE (i_class IN ($classes1) AND i_category IN ($cats1)) OR (i_class IN ($classes2) AND i_category IN ($cats2))),
monthly AS (
  SELECT i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, CAST(sum(ss_sales_price) AS DECIMAL(38,2)) AS s
  FROM store_sales JOIN choice ON good = ss_item_sk JOIN store ON s_store_sk = ss_store_sk
  JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year = $year
  GROUP BY ALL),
usual AS (SELECT *, CAST(sum(s) OVER w AS DOUBLE) / count(s) OVER w AS a, round(CAST(sum(s) OVER w * 10000 AS DOUBLE) / count(s) OVER w) / 10000 AS a4 FROM monthly
          WINDOW w AS (PARTITION BY i_category, i_brand, s_store_name, s_company_name)),
picked AS (SELECT * FROM usual WHERE a <> 0 AND abs(CAST(s AS DOUBLE) - a) / a > 0.1
           ORDER BY CAST(s AS DOUBLE) - a, s_store_name NULLS LAST, i_category, i_class, i_brand, s_company_name, d_moy LIMIT 100)
SELECT i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, s AS sum_sales, a4 AS avg_monthly_sales FROM picked
