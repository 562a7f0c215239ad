, choice AS (
  SELECT i_item_sk AS good, i_manufact_id FROM item
  WHERE (i_brand IN ('Brand#15', 'Brand#17', 'Brand#23', 'Brand#25') AND i_category IN ('Books', 'Children', 'Electronics')
         AND i_class IN ('personal', 'portable', 'reference', 'self-help'))
     OR (i_brand IN ('Brand#1', 'Brand#4', 'Brand#11', 'Brand#15') AND i_category IN ('Men', 'Music', 'Women')
         AND i_class IN ('accessories', 'classical', 'fragrances', 'pants'))),
quarterly AS (
  SELECT i_manufact_id, d_qoy, CAST(sum(ss_sales_price) AS DECIMAL(38,2)) AS s
  FROM store_sales JOIN choice ON good = ss_item_sk JOIN store ON s_store_sk = ss_store_sk
  JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_month_seq BETWEEN $month_seq AND $month_seq + 11
  GROUP BY ALL),
usual AS (SELECT *, CAST(sum(s) OVER w AS DOUBLE) / count(s) OVER w AS a, round(CAST(sum(s) OVER w * 10000 AS DOUBLE) / count(s) OVER w) / 10000 AS a4 FROM quarterly WINDOW w AS (PARTITION BY i_manufact_id)),
picked AS (SELECT * FROM usual WHERE a > 0 AND abs(CAST(s AS DOUBLE) - a) / a > 0.1
           ORDER BY a, s NULLS LAST, i_manufact_id NULLS LAST LIMIT 100)
SELECT i_manufact_id, s AS sum_sales, a4 AS avg_quarterly_sales FROM picked
