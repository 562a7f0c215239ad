SELECT i_brand_id AS brand_id, i_brand AS brand, i_manufact_id, i_manufact,
       CAST(sum(ss_ext_sales_price) AS DECIMAL(38,2)) AS ext_price
FROM store_sales
JOIN date_dim ON d_date_sk = ss_sold_date_sk
JOIN item ON ss_item_sk = i_item_sk
JOIN customer ON ss_customer_sk = c_customer_sk
JOIN customer_address ON c_current_addr_sk = ca_address_sk
JOIN store ON ss_store_sk = s_store_sk
WHERE i_manager_id = $manager_id AND d_moy = $moy AND d_year = $year
  AND substr(ca_zip, 1, 5) <> substr(s_zip, 1, 5)
GROUP BY i_brand, i_brand_id, i_manufact_id, i_manufact
ORDER BY ext_price DESC NULLS FIRST, brand NULLS LAST, brand_id NULLS LAST, i_manufact_id NULLS LAST, i_manufact NULLS LAST
LIMIT 100
