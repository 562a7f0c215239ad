SELECT w_state, i_item_id,
  CAST(sum(CASE WHEN d_date < CAST('$day' AS DATE) THEN cs_sales_price - coalesce(cr_refunded_cash, 0) ELSE 0 END) AS DECIMAL(38,2)) AS sales_before,
  CAST(sum(CASE WHEN d_date >= CAST('$day' AS DATE) THEN cs_sales_price - coalesce(cr_refunded_cash, 0) ELSE 0 END) AS DECIMAL(38,2)) AS sales_after
FROM catalog_sales LEFT OUTER JOIN catalog_returns ON cs_order_number = cr_order_number AND cs_item_sk = cr_item_sk,
     warehouse, item, date_dim
WHERE i_current_price BETWEEN $lo_price AND $hi_price AND i_item_sk = cs_item_sk AND cs_warehouse_sk = w_warehouse_sk
  AND cs_sold_date_sk = d_date_sk
  AND d_date BETWEEN CAST('$day' AS DATE) - 30 AND CAST('$day' AS DATE) + 30
GROUP BY w_state, i_item_id
ORDER BY w_state NULLS LAST, i_item_id NULLS LAST, sales_before, sales_after
LIMIT 100
