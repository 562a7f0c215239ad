SELECT i_item_desc, i_category, i_class, i_current_price,
       CAST(sum(ws_ext_sales_price) AS DECIMAL(38,2)) AS itemrevenue,
       round(CAST(sum(ws_ext_sales_price) * 100000000 AS DOUBLE) / CAST(sum(sum(ws_ext_sales_price)) OVER (PARTITION BY i_class) * 100 AS DOUBLE)) / 10000
         AS revenueratio
FROM web_sales
JOIN item ON ws_item_sk = i_item_sk
JOIN date_dim ON ws_sold_date_sk = d_date_sk
WHERE i_category IN ($categories)
  AND d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 30
GROUP BY i_item_id, i_item_desc, i_category, i_class, i_current_price
ORDER BY i_category NULLS LAST, i_class NULLS LAST, i_item_id NULLS LAST, i_item_desc NULLS LAST,
         revenueratio NULLS LAST
LIMIT 100
