,  sr_items AS (
  SELECT i_item_id AS item_id, sum(sr_return_quantity) AS sr_item_qty
  FROM store_returns, item, date_dim
  WHERE sr_item_sk = i_item_sk AND d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq IN (SELECT d_week_seq FROM date_dim WHERE d_date IN (SELECT CAST(unnest([$days]) AS DATE))))
    AND sr_returned_date_sk = d_date_sk
  GROUP BY i_item_id),
 cr_items AS (
  SELECT i_item_id AS item_id, sum(cr_return_quantity) AS cr_item_qty
  FROM catalog_returns, item, date_dim
  WHERE cr_item_sk = i_item_sk AND d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq IN (SELECT d_week_seq FROM date_dim WHERE d_date IN (SELECT CAST(unnest([$days]) AS DATE))))
    AND cr_returned_date_sk = d_date_sk
  GROUP BY i_item_id),
 wr_items AS (
  SELECT i_item_id AS item_id, sum(wr_return_quantity) AS wr_item_qty
  FROM web_returns, item, date_dim
  WHERE wr_item_sk = i_item_sk AND d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq IN (SELECT d_week_seq FROM date_dim WHERE d_date IN (SELECT CAST(unnest([$days]) AS DATE))))
    AND wr_returned_date_sk = d_date_sk
  GROUP BY i_item_id)
SELECT sr_items.item_id, CAST(sr_item_qty AS BIGINT) AS sr_item_qty,
       round(CAST(sr_item_qty * 100000000 AS DOUBLE) / CAST((sr_item_qty + cr_item_qty + wr_item_qty) * 300 AS DOUBLE)) / 10000 AS sr_dev,
       CAST(cr_item_qty AS BIGINT) AS cr_item_qty,
       round(CAST(cr_item_qty * 100000000 AS DOUBLE) / CAST((sr_item_qty + cr_item_qty + wr_item_qty) * 300 AS DOUBLE)) / 10000 AS cr_dev,
       CAST(wr_item_qty AS BIGINT) AS wr_item_qty,
       round(CAST(wr_item_qty * 100000000 AS DOUBLE) / CAST((sr_item_qty + cr_item_qty + wr_item_qty) * 300 AS DOUBLE)) / 10000 AS wr_dev,
       round(CAST((sr_item_qty + cr_item_qty + wr_item_qty) * 10000 AS DOUBLE) / 3) / 10000 AS average
FROM sr_items, cr_items, wr_items
WHERE sr_items.item_id = cr_items.item_id AND sr_items.item_id = wr_items.item_id
ORDER BY sr_items.item_id NULLS LAST, sr_item_qty NULLS LAST, sr_dev, cr_item_qty, cr_dev, wr_item_qty, wr_dev, average
LIMIT 100
