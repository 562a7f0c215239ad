SELECT ca_state, cd_gender, cd_marital_status, count(*) AS cnt1,
       round(CAST(sum(cd_dep_count) * 10000 AS DOUBLE) / count(cd_dep_count)) / 10000 AS avg_dep, max(cd_dep_count) AS max_dep,
       CAST(sum(cd_dep_count) AS BIGINT) AS sum_dep,
       cd_dep_employed_count, count(*) AS cnt2,
       round(CAST(sum(cd_dep_employed_count) * 10000 AS DOUBLE) / count(cd_dep_employed_count)) / 10000 AS avg_emp, max(cd_dep_employed_count) AS max_emp,
       CAST(sum(cd_dep_employed_count) AS BIGINT) AS sum_emp,
       cd_dep_college_count, count(*) AS cnt3,
       round(CAST(sum(cd_dep_college_count) * 10000 AS DOUBLE) / count(cd_dep_college_count)) / 10000 AS avg_col, max(cd_dep_college_count) AS max_col,
       CAST(sum(cd_dep_college_count) AS BIGINT) AS sum_col
FROM customer c, customer_address ca, customer_demographics
WHERE c.c_current_addr_sk = ca.ca_address_sk AND cd_demo_sk = c.c_current_cdemo_sk
  AND EXISTS (SELECT * FROM store_sales, date_dim WHERE c.c_customer_sk = ss_customer_sk AND ss_sold_date_sk = d_date_sk AND d_year = $year AND d_qoy < $max_qoy)
  AND (EXISTS (SELECT * FROM web_sales, date_dim WHERE c.c_customer_sk = ws_bill_customer_sk AND ws_sold_date_sk = d_date_sk AND d_year = $year AND d_qoy < $max_qoy)
    OR EXISTS (SELECT * FROM catalog_sales, date_dim WHERE c.c_customer_sk = cs_ship_customer_sk AND cs_sold_date_sk = d_date_sk AND d_year = $year AND d_qoy < $max_qoy))
GROUP BY ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, cd_dep_college_count
ORDER BY ca_state NULLS LAST, cd_gender NULLS LAST, cd_marital_status NULLS LAST, cd_dep_count NULLS LAST,
         cd_dep_employed_count NULLS LAST, cd_dep_college_count NULLS LAST
LIMIT 100
