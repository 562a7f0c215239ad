SELECT d.d_year, i.i_brand_id AS brand_id, i.i_brand AS brand,
       CAST(sum(s.ss_ext_sales_price) AS DECIMAL(38,2)) AS sum_agg
FROM store_sales s
JOIN date_dim d ON d.d_date_sk = s.ss_sold_date_sk
JOIN item i ON i.i_item_sk = s.ss_item_sk
WHERE i.i_manufact_id = $manufact_id AND d.d_moy = $moy
GROUP BY d.d_year, i.i_brand, i.i_brand_id
ORDER BY d_year NULLS LAST, sum_agg DESC NULLS FIRST, brand_id NULLS LAST, brand NULLS LAST
LIMIT 100
