SELECT d_year, i_category_id, i_category, CAST(sum(ss_ext_sales_price) AS DECIMAL(38,2)) AS sum_sales
FROM store_sales
JOIN date_dim ON d_date_sk = ss_sold_date_sk
JOIN item ON ss_item_sk = i_item_sk
WHERE i_manager_id = $manager_id AND d_moy = $moy AND d_year = $year
GROUP BY d_year, i_category_id, i_category
ORDER BY sum_sales DESC NULLS FIRST, d_year NULLS LAST, i_category_id NULLS LAST, i_category NULLS LAST
LIMIT 100
