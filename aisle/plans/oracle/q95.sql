, ws_wh AS (SELECT ws1.ws_order_number, ws1.ws_warehouse_sk AS wh1, ws2.ws_warehouse_sk AS wh2
                FROM web_sales ws1, web_sales ws2
                WHERE ws1.ws_order_number = ws2.ws_order_number AND ws1.ws_warehouse_sk <> ws2.ws_warehouse_sk)
SELECT count(DISTINCT ws_order_number) AS "order count",
       CAST(sum(ws_ext_ship_cost) AS DECIMAL(38,2)) AS "total shipping cost",
       CAST(sum(ws_net_profit) AS DECIMAL(38,2)) AS "total net profit"
FROM web_sales x1, date_dim, customer_address, web_site
WHERE d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 60
  AND x1.ws_ship_date_sk = d_date_sk AND x1.ws_ship_addr_sk = ca_address_sk AND ca_state = '$state'
  AND x1.ws_web_site_sk = web_site_sk AND web_company_name = '$company'
  AND x1.ws_order_number IN (SELECT ws_order_number FROM ws_wh)
  AND x1.ws_order_number IN (SELECT wr_order_number FROM web_returns, ws_wh WHERE wr_order_number = ws_wh.ws_order_number)
ORDER BY 1
LIMIT 100
