SELECT round(CAST(sum(ss_quantity) * 10000 AS DOUBLE) / count(ss_quantity)) / 10000 AS avg_quantity,
       round(CAST(sum(ss_ext_sales_price) * 10000 AS DOUBLE) / count(ss_ext_sales_price)) / 10000 AS avg_ext_sales_price,
       round(CAST(sum(ss_ext_wholesale_cost) * 10000 AS DOUBLE) / count(ss_ext_wholesale_cost)) / 10000 AS avg_ext_wholesale_cost,
       CAST(sum(ss_ext_wholesale_cost) AS DECIMAL(38,2)) AS sum_ext_wholesale_cost
FROM store_sales, store, customer_demographics, household_demographics, customer_address, date_dim
WHERE s_store_sk = ss_store_sk AND ss_sold_date_sk = d_date_sk AND d_year = $year
  AND ((ss_hdemo_sk = hd_demo_sk AND cd_demo_sk = ss_cdemo_sk AND cd_marital_status = '$m1'
        AND cd_education_status = '$e1' AND ss_sales_price BETWEEN 100.00 AND 150.00 AND hd_dep_count = $dep1)
    OR (ss_hdemo_sk = hd_demo_sk AND cd_demo_sk = ss_cdemo_sk AND cd_marital_status = '$m2'
        AND cd_education_status = '$e2' AND ss_sales_price BETWEEN 50.00 AND 100.00 AND hd_dep_count = $dep2)
    OR (ss_hdemo_sk = hd_demo_sk AND cd_demo_sk = ss_cdemo_sk AND cd_marital_status = '$m3'
        AND cd_education_status = '$e3' AND ss_sales_price BETWEEN 150.00 AND 200.00 AND hd_dep_count = $dep3))
  AND ((ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ($states1)
        AND ss_net_profit BETWEEN 0 AND 2000)
    OR (ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ($states2)
        AND ss_net_profit BETWEEN 150 AND 3000)
    OR (ss_addr_sk = ca_address_sk AND ca_country = 'United States' AND ca_state IN ($states3)
        AND ss_net_profit BETWEEN 50 AND 25000))
