SELECT ca_zip, CAST(sum(cs_sales_price) AS DECIMAL(38,2)) AS sum_sales_price
FROM catalog_sales
JOIN customer ON cs_bill_customer_sk = c_customer_sk
JOIN customer_address ON c_current_addr_sk = ca_address_sk
JOIN date_dim ON cs_sold_date_sk = d_date_sk
WHERE (substr(ca_zip, 1, 5) IN ($zips) OR ca_state IN ($states) OR cs_sales_price > $price)
  AND d_qoy = $qoy AND d_year = $year
GROUP BY ca_zip
ORDER BY ca_zip NULLS LAST, sum_sales_price
LIMIT 100
