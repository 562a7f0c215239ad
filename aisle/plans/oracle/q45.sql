SELECT ca_zip, ca_county, CAST(sum(ws_sales_price) AS DECIMAL(38,2)) AS sum_sales_price
FROM web_sales, customer, customer_address, date_dim, item
WHERE ws_bill_customer_sk = c_customer_sk AND c_current_addr_sk = ca_address_sk AND ws_item_sk = i_item_sk
  AND (substr(ca_zip, 1, 5) IN ($zips)
       OR i_item_id IN (SELECT i_item_id FROM item WHERE i_item_sk IN ($item_sks)))
  AND ws_sold_date_sk = d_date_sk AND d_qoy = $qoy AND d_year = $year
GROUP BY ca_zip, ca_county
ORDER BY ca_zip NULLS LAST, ca_county NULLS LAST, sum_sales_price
LIMIT 100
