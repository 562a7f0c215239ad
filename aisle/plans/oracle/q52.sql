SELECT d_year, i_brand_id AS brand_id, i_brand AS brand, CAST(sum(ss_ext_sales_price) AS DECIMAL(38,2)) AS ext_price
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN item ON ss_item_sk = i_item_sk
WHERE i_manager_id = $manager_id AND d_moy = $moy AND d_year = $year
GROUP BY d_year, i_brand, i_brand_id
ORDER BY d_year NULLS LAST, ext_price DESC NULLS FIRST, brand_id NULLS LAST, brand NULLS LAST
LIMIT 100
