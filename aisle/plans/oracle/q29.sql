SELECT i_item_id, i_item_desc, s_store_id, s_store_name,
       CAST(sum(ss_quantity) AS BIGINT) AS store_sales_quantity,
       CAST(sum(sr_return_quantity) AS BIGINT) AS store_returns_quantity,
       CAST(sum(cs_quantity) AS BIGINT) AS catalog_sales_quantity
FROM store_sales, store_returns, catalog_sales, date_dim d1, date_dim d2, date_dim d3, store, item
WHERE d1.d_moy = $moy AND d1.d_year = $year AND d1.d_date_sk = ss_sold_date_sk AND i_item_sk = ss_item_sk AND s_store_sk = ss_store_sk
  AND ss_customer_sk = sr_customer_sk AND ss_item_sk = sr_item_sk AND ss_ticket_number = sr_ticket_number
  AND sr_returned_date_sk = d2.d_date_sk AND d2.d_moy BETWEEN $moy AND $moy + 3 AND d2.d_year = $year
  AND sr_customer_sk = cs_bill_customer_sk AND sr_item_sk = cs_item_sk
  AND cs_sold_date_sk = d3.d_date_sk AND d3.d_year IN ($year, $year + 1, $year + 2)
GROUP BY i_item_id, i_item_desc, s_store_id, s_store_name
ORDER BY i_item_id NULLS LAST, i_item_desc NULLS LAST, s_store_id NULLS LAST, s_store_name NULLS LAST,
         store_sales_quantity, store_returns_quantity, catalog_sales_quantity
LIMIT 100
