SELECT i_item_id, i_item_desc, s_store_id, s_store_name,
       CAST(sum(ss_net_profit) AS DECIMAL(38,2)) AS store_sales_profit,
       CAST(sum(sr_net_loss) AS DECIMAL(38,2)) AS store_returns_loss,
       CAST(sum(cs_net_profit) AS DECIMAL(38,2)) AS catalog_sales_profit
FROM store_sales, store_returns, catalog_sales, date_dim d1, date_dim d2, date_dim d3, store, item
WHERE d1.d_moy = $moy AND d1.d_year = $year AND d1.d_date_sk = ss_sold_date_sk AND i_item_sk = ss_item_sk AND s_store_sk = ss_store_sk
  AND ss_customer_sk = sr_customer_sk AND ss_item_sk = sr_item_sk AND ss_ticket_number = sr_ticket_number
  AND sr_returned_date_sk = d2.d_date_sk AND d2.d_moy BETWEEN $moy AND $moy_hi AND d2.d_year = $year
  AND sr_customer_sk = cs_bill_customer_sk AND sr_item_sk = cs_item_sk
  AND cs_sold_date_sk = d3.d_date_sk AND d3.d_moy BETWEEN $moy AND $moy_hi AND d3.d_year = $year
GROUP BY i_item_id, i_item_desc, s_store_id, s_store_name
ORDER BY i_item_id NULLS LAST, i_item_desc NULLS LAST, s_store_id NULLS LAST, s_store_name NULLS LAST,
         store_sales_profit, store_returns_loss, catalog_sales_profit
LIMIT 100
