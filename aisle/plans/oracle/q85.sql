SELECT substr(r_reason_desc, 1, 20) AS reason20, round(CAST(sum(ws_quantity) * 10000 AS DOUBLE) / count(ws_quantity)) / 10000 AS avg_qty,
       round(CAST(sum(wr_refunded_cash) * 10000 AS DOUBLE) / count(wr_refunded_cash)) / 10000 AS avg_cash, round(CAST(sum(wr_fee) * 10000 AS DOUBLE) / count(wr_fee)) / 10000 AS avg_fee
FROM web_sales, web_returns, web_page, customer_demographics cd1, customer_demographics cd2, customer_address, date_dim, reason
WHERE ws_web_page_sk = wp_web_page_sk AND ws_item_sk = wr_item_sk AND ws_order_number = wr_order_number
  AND ws_sold_date_sk = d_date_sk AND d_year = $year AND cd1.cd_demo_sk = wr_refunded_cdemo_sk
  AND cd2.cd_demo_sk = wr_returning_cdemo_sk AND ca_address_sk = wr_refunded_addr_sk AND r_reason_sk = wr_reason_sk
  AND ((cd1.cd_marital_status = '$m1' AND cd1.cd_marital_status = cd2.cd_marital_status AND cd1.cd_education_status = '$e1'
        AND cd1.cd_education_status = cd2.cd_education_status AND ws_sales_price BETWEEN 100.00 AND 150.00)
    OR (cd1.cd_marital_status = '$m2' AND cd1.cd_marital_status = cd2.cd_marital_status AND cd1.cd_education_status = '$e2'
        AND cd1.cd_education_status = cd2.cd_education_status AND ws_sales_price BETWEEN 50.00 AND 100.00)
    OR (cd1.cd_marital_status = '$m3' AND cd1.cd_marital_status = cd2.cd_marital_status AND cd1.cd_education_status = '$e3'
        AND cd1.cd_education_status = cd2.cd_education_status AND ws_sales_price BETWEEN 150.00 AND 200.00))
  AND ((ca_country = 'United States' AND ca_state IN ($states1) AND ws_net_profit BETWEEN 0 AND 2000)
    OR (ca_country = 'United States' AND ca_state IN ($states2) AND ws_net_profit BETWEEN 150 AND 3000)
    OR (ca_country = 'United States' AND ca_state IN ($states3) AND ws_net_profit BETWEEN 50 AND 25000))
GROUP BY r_reason_desc
ORDER BY reason20 NULLS LAST, avg_qty NULLS LAST, avg_cash NULLS LAST, avg_fee NULLS LAST
LIMIT 100
