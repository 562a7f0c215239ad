SELECT c_last_name, c_first_name, current_addr.ca_city, bought_city, ss_ticket_number, amt, profit
FROM (SELECT ss_ticket_number, ss_customer_sk, ca_city AS bought_city,
             CAST(sum(ss_coupon_amt) AS DECIMAL(38,2)) AS amt, CAST(sum(ss_net_profit) AS DECIMAL(38,2)) AS profit
      FROM store_sales, date_dim, store, household_demographics, customer_address
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_hdemo_sk = hd_demo_sk
        AND ss_addr_sk = ca_address_sk AND (hd_dep_count = $dep OR hd_vehicle_count = $vehicles)
        AND d_dow IN ($dows) AND d_year IN ($years) AND s_city IN ($cities)
      GROUP BY ss_ticket_number, ss_customer_sk, ss_addr_sk, ca_city) dn, customer, customer_address current_addr
WHERE ss_customer_sk = c_customer_sk AND c_current_addr_sk = current_addr.ca_address_sk
  AND current_addr.ca_city <> bought_city
ORDER BY c_last_name NULLS LAST, c_first_name NULLS LAST, ca_city NULLS LAST, bought_city NULLS LAST,
         ss_ticket_number NULLS LAST, amt, profit
LIMIT 100
