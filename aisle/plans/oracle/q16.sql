SELECT count(DISTINCT cs_order_number) AS "order count",
       CAST(sum(cs_ext_ship_cost) AS DECIMAL(38,2)) AS "total shipping cost",
       CAST(sum(cs_net_profit) AS DECIMAL(38,2)) AS "total net profit"
FROM catalog_sales x1, date_dim, customer_address, call_center
WHERE d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 60
  AND x1.cs_ship_date_sk = d_date_sk AND x1.cs_ship_addr_sk = ca_address_sk AND ca_state = '$state'
  AND x1.cs_call_center_sk = cc_call_center_sk AND cc_county IN ($counties)
  AND EXISTS (SELECT * FROM catalog_sales x2 WHERE x1.cs_order_number = x2.cs_order_number
                                            AND x1.cs_warehouse_sk <> x2.cs_warehouse_sk)
  AND NOT EXISTS (SELECT * FROM catalog_returns r1 WHERE x1.cs_order_number = r1.cr_order_number)
ORDER BY 1
LIMIT 100
