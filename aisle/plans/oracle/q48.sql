SELECT CAST(sum(ss_quantity) AS BIGINT) AS sum_quantity
FROM store_sales
JOIN store ON s_store_sk = ss_store_sk
JOIN date_dim ON ss_sold_date_sk = d_date_sk
JOIN customer_demographics ON cd_demo_sk = ss_cdemo_sk
JOIN customer_address ON ss_addr_sk = ca_address_sk
WHERE d_year = $year
  AND ((cd_marital_status = '$marital' AND cd_education_status = '$education' AND ss_sales_price BETWEEN 100.00 AND 150.00)
    OR (cd_marital_status = '$marital' AND cd_education_status = '$education' AND ss_sales_price BETWEEN 50.00 AND 100.00)
    OR (cd_marital_status = '$marital' AND cd_education_status = '$education' AND ss_sales_price BETWEEN 150.00 AND 200.00))
  AND ((ca_country = 'United States' AND ca_state IN ($states1) AND ss_net_profit BETWEEN 0 AND 2000)
    OR (ca_country = 'United States' AND ca_state IN ($states2) AND ss_net_profit BETWEEN 150 AND 3000)
    OR (ca_country = 'United States' AND ca_state IN ($states3) AND ss_net_profit BETWEEN 50 AND 25000))
