,  ss_items AS (
  SELECT i_item_id AS item_id, sum(ss_ext_sales_price) AS ss_item_rev
  FROM store_sales, item, date_dim
  WHERE ss_item_sk = i_item_sk AND d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq = (SELECT d_week_seq FROM date_dim WHERE d_date = CAST('$day' AS DATE)))
    AND ss_sold_date_sk = d_date_sk
  GROUP BY i_item_id),
 cs_items AS (
  SELECT i_item_id AS item_id, sum(cs_ext_sales_price) AS cs_item_rev
  FROM catalog_sales, item, date_dim
  WHERE cs_item_sk = i_item_sk AND d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq = (SELECT d_week_seq FROM date_dim WHERE d_date = CAST('$day' AS DATE)))
    AND cs_sold_date_sk = d_date_sk
  GROUP BY i_item_id),
 ws_items AS (
  SELECT i_item_id AS item_id, sum(ws_ext_sales_price) AS ws_item_rev
  FROM web_sales, item, date_dim
  WHERE ws_item_sk = i_item_sk AND d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq = (SELECT d_week_seq FROM date_dim WHERE d_date = CAST('$day' AS DATE)))
    AND ws_sold_date_sk = d_date_sk
  GROUP BY i_item_id)
SELECT ss_items.item_id, CAST(ss_item_rev AS DECIMAL(38,2)) AS ss_item_rev,
       round(CAST(ss_item_rev * 100000000 AS DOUBLE) / CAST((ss_item_rev + cs_item_rev + ws_item_rev) * 300 AS DOUBLE)) / 10000 AS ss_dev,
       CAST(cs_item_rev AS DECIMAL(38,2)) AS cs_item_rev,
       round(CAST(cs_item_rev * 100000000 AS DOUBLE) / CAST((ss_item_rev + cs_item_rev + ws_item_rev) * 300 AS DOUBLE)) / 10000 AS cs_dev,
       CAST(ws_item_rev AS DECIMAL(38,2)) AS ws_item_rev,
       round(CAST(ws_item_rev * 100000000 AS DOUBLE) / CAST((ss_item_rev + cs_item_rev + ws_item_rev) * 300 AS DOUBLE)) / 10000 AS ws_dev,
       round(CAST((ss_item_rev + cs_item_rev + ws_item_rev) * 10000 AS DOUBLE) / 3) / 10000 AS average
FROM ss_items, cs_items, ws_items
WHERE ss_items.item_id = cs_items.item_id AND ss_items.item_id = ws_items.item_id
  AND ss_item_rev BETWEEN $lo * cs_item_rev AND $hi * cs_item_rev
  AND ss_item_rev BETWEEN $lo * ws_item_rev AND $hi * ws_item_rev
  AND cs_item_rev BETWEEN $lo * ss_item_rev AND $hi * ss_item_rev
  AND cs_item_rev BETWEEN $lo * ws_item_rev AND $hi * ws_item_rev
  AND ws_item_rev BETWEEN $lo * ss_item_rev AND $hi * ss_item_rev
  AND ws_item_rev BETWEEN $lo * cs_item_rev AND $hi * cs_item_rev
ORDER BY item_id NULLS LAST, ss_item_rev NULLS LAST, ss_dev, cs_item_rev, cs_dev, ws_item_rev, ws_dev, average
LIMIT 100
