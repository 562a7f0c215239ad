SELECT c_last_name, c_first_name, current_addr.ca_city, bought_city, ss_ticket_number, extended_price,
       extended_tax, list_price
FROM (SELECT ss_ticket_number, ss_customer_sk, ca_city AS bought_city,
             CAST(sum(ss_ext_sales_price) AS DECIMAL(38,2)) AS extended_price,
             CAST(sum(ss_ext_list_price) AS DECIMAL(38,2)) AS list_price,
             CAST(sum(ss_ext_tax) AS DECIMAL(38,2)) AS extended_tax
      FROM store_sales, date_dim, store, household_demographics, customer_address
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_hdemo_sk = hd_demo_sk
        AND ss_addr_sk = ca_address_sk AND d_dom BETWEEN 1 AND $dom_hi
        AND (hd_dep_count = $dep OR hd_vehicle_count = $vehicles) AND d_year IN ($years) AND s_city IN ($cities)
      GROUP BY ss_ticket_number, ss_customer_sk, ss_addr_sk, ca_city) dn, customer, customer_address current_addr
WHERE ss_customer_sk = c_customer_sk AND c_current_addr_sk = current_addr.ca_address_sk
  AND current_addr.ca_city <> bought_city
ORDER BY c_last_name NULLS LAST, ss_ticket_number NULLS LAST, c_first_name, ca_city, bought_city, extended_price,
         extended_tax, list_price
LIMIT 100
