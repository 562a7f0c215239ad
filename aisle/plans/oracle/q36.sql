, sums AS (
  SELECT i_category, i_class, grouping(i_category) + grouping(i_class) AS level, grouping(i_class) AS whole,
         CAST(sum(ss_net_profit) AS DOUBLE) / CAST(sum(ss_ext_sales_price) AS DOUBLE) AS margin,
         round(CAST(sum(ss_net_profit) * 1000000 AS DOUBLE) / CAST(sum(ss_ext_sales_price) * 100 AS DOUBLE)) / 10000 AS margin4
  FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year = $year
  JOIN store ON s_store_sk = ss_store_sk AND s_state IN ($states)
  JOIN item ON i_item_sk = ss_item_sk
  GROUP BY ROLLUP (i_category, i_class)),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY level, CASE WHEN whole = 0 THEN i_category END ORDER BY margin) AS place FROM sums
  ORDER BY level DESC, CASE WHEN level = 0 THEN i_category END NULLS LAST, place, margin, i_category NULLS LAST, i_class NULLS LAST
  LIMIT 100)
SELECT margin4 AS gross_margin, i_category, i_class, CAST(level AS INT) AS lochierarchy, place AS rank_within_parent
FROM ranked
