SELECT promotions, total,
       round(CAST(promotions * 100000000 AS DOUBLE) / CAST(NULLIF(total, 0) * 100 AS DOUBLE)) / 10000 AS promo_pct
FROM (SELECT CAST(sum(ss_ext_sales_price) AS DECIMAL(38,2)) AS promotions
      FROM store_sales, store, promotion, date_dim, customer, customer_address, item
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_promo_sk = p_promo_sk
        AND ss_customer_sk = c_customer_sk AND ca_address_sk = c_current_addr_sk AND ss_item_sk = i_item_sk
        AND ca_gmt_offset = $gmt AND i_category = '$category'
        AND (p_channel_dmail = 'Y' OR p_channel_email = 'Y' OR p_channel_tv = 'Y')
        AND s_gmt_offset = $gmt AND d_year = $year AND d_moy = $moy) promotional_sales,
     (SELECT CAST(sum(ss_ext_sales_price) AS DECIMAL(38,2)) AS total
      FROM store_sales, store, date_dim, customer, customer_address, item
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_customer_sk = c_customer_sk
        AND ca_address_sk = c_current_addr_sk AND ss_item_sk = i_item_sk AND ca_gmt_offset = $gmt
        AND i_category = '$category' AND s_gmt_offset = $gmt AND d_year = $year AND d_moy = $moy) all_sales
ORDER BY promotions, total
LIMIT 100
