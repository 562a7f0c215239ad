SELECT i_item_id, round(CAST(sum(ss_quantity) * 10000 AS DOUBLE) / count(ss_quantity)) / 10000 AS agg1, round(CAST(sum(ss_list_price) * 10000 AS DOUBLE) / count(ss_list_price)) / 10000 AS agg2,
       round(CAST(sum(ss_coupon_amt) * 10000 AS DOUBLE) / count(ss_coupon_amt)) / 10000 AS agg3, round(CAST(sum(ss_sales_price) * 10000 AS DOUBLE) / count(ss_sales_price)) / 10000 AS agg4
FROM store_sales
JOIN customer_demographics ON ss_cdemo_sk = cd_demo_sk
JOIN date_dim ON ss_sold_date_sk = d_date_sk
JOIN item ON ss_item_sk = i_item_sk
JOIN promotion ON ss_promo_sk = p_promo_sk
WHERE cd_gender = '$gender' AND cd_marital_status = '$marital' AND cd_education_status = '$education'
  AND (p_channel_email = 'N' OR p_channel_event = 'N') AND d_year = $year
GROUP BY i_item_id
ORDER BY i_item_id NULLS LAST, agg1, agg2, agg3, agg4
LIMIT 100
