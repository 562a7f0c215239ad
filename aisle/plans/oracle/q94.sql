SELECT count(DISTINCT ws_order_number) AS "order count",
       CAST(sum(ws_ext_ship_cost) AS DECIMAL(38,2)) AS "total shipping cost",
       CAST(sum(ws_net_profit) AS DECIMAL(38,2)) AS "total net profit"
FROM web_sales x1, date_dim, customer_address, web_site
WHERE d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 60
  AND x1.ws_ship_date_sk = d_date_sk AND x1.ws_ship_addr_sk = ca_address_sk AND ca_state = '$state'
  AND x1.ws_web_site_sk = web_site_sk AND web_company_name = '$company'
  AND EXISTS (SELECT * FROM web_sales x2 WHERE x1.ws_order_number = x2.ws_order_number
                                            AND x1.ws_warehouse_sk <> x2.ws_warehouse_sk)
  AND NOT EXISTS (SELECT * FROM web_returns r1 WHERE x1.ws_order_number = r1.wr_order_number)
ORDER BY 1
LIMIT 100
