SELECT * FROM (
  SELECT w_warehouse_name, i_item_id,
         CAST(sum(CASE WHEN d_date < CAST('$day' AS DATE) THEN inv_quantity_on_hand ELSE 0 END) AS BIGINT) AS inv_before,
         CAST(sum(CASE WHEN d_date >= CAST('$day' AS DATE) THEN inv_quantity_on_hand ELSE 0 END) AS BIGINT) AS inv_after
  FROM inventory, warehouse, item, date_dim
  WHERE i_current_price BETWEEN $lo_price AND $hi_price AND i_item_sk = inv_item_sk AND inv_warehouse_sk = w_warehouse_sk
    AND inv_date_sk = d_date_sk
    AND d_date BETWEEN CAST('$day' AS DATE) - 30 AND CAST('$day' AS DATE) + 30
  GROUP BY w_warehouse_name, i_item_id) x
WHERE (CASE WHEN inv_before > 0 THEN inv_after // inv_before ELSE NULL END) BETWEEN 2.0 / 3.0 AND 3.0 / 2.0
ORDER BY w_warehouse_name NULLS LAST, i_item_id NULLS LAST, inv_before, inv_after
LIMIT 100
