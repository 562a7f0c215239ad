SELECT i_item_id, s_state, CAST(grouping(s_state) AS INT) AS g_state,
       round(CAST(sum(ss_quantity) * 10000 AS DOUBLE) / count(ss_quantity)) / 10000 AS agg1, round(CAST(sum(ss_list_price) * 10000 AS DOUBLE) / count(ss_list_price)) / 10000 AS agg2,
       round(CAST(sum(ss_coupon_amt) * 10000 AS DOUBLE) / count(ss_coupon_amt)) / 10000 AS agg3, round(CAST(sum(ss_sales_price) * 10000 AS DOUBLE) / count(ss_sales_price)) / 10000 AS agg4
FROM store_sales, customer_demographics, date_dim, store, item
WHERE ss_sold_date_sk = d_date_sk AND ss_item_sk = i_item_sk AND ss_store_sk = s_store_sk AND ss_cdemo_sk = cd_demo_sk
  AND cd_gender = '$gender' AND cd_marital_status = '$marital' AND cd_education_status = '$education'
  AND d_year = $year AND s_state IN ($states)
GROUP BY ROLLUP (i_item_id, s_state)
ORDER BY i_item_id NULLS LAST, s_state NULLS LAST, g_state, agg1, agg2, agg3, agg4
LIMIT 100
