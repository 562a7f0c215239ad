SELECT i_item_id, ca_country, ca_state, ca_county,
       round(CAST(sum(cs_quantity) * 10000 AS DOUBLE) / count(cs_quantity)) / 10000 AS agg1,
       round(CAST(sum(cs_list_price) * 10000 AS DOUBLE) / count(cs_list_price)) / 10000 AS agg2,
       round(CAST(sum(cs_coupon_amt) * 10000 AS DOUBLE) / count(cs_coupon_amt)) / 10000 AS agg3,
       round(CAST(sum(cs_sales_price) * 10000 AS DOUBLE) / count(cs_sales_price)) / 10000 AS agg4,
       round(CAST(sum(cs_net_profit) * 10000 AS DOUBLE) / count(cs_net_profit)) / 10000 AS agg5,
       round(CAST(sum(c_birth_year) * 10000 AS DOUBLE) / count(c_birth_year)) / 10000 AS agg6,
       round(CAST(sum(cd1.cd_dep_count) * 10000 AS DOUBLE) / count(cd1.cd_dep_count)) / 10000 AS agg7
FROM catalog_sales, customer_demographics cd1, customer_demographics cd2, customer, customer_address, date_dim, item
WHERE cs_sold_date_sk = d_date_sk AND cs_item_sk = i_item_sk AND cs_bill_cdemo_sk = cd1.cd_demo_sk
  AND cs_bill_customer_sk = c_customer_sk AND cd1.cd_gender = '$gender' AND cd1.cd_education_status = '$education'
  AND c_current_cdemo_sk = cd2.cd_demo_sk AND c_current_addr_sk = ca_address_sk
  AND c_birth_month IN ($months) AND d_year = $year AND ca_state IN ($states)
GROUP BY ROLLUP (i_item_id, ca_country, ca_state, ca_county)
ORDER BY ca_country NULLS LAST, ca_state NULLS LAST, ca_county NULLS LAST, i_item_id NULLS LAST,
         agg1, agg2, agg3, agg4, agg5, agg6, agg7
LIMIT 100
