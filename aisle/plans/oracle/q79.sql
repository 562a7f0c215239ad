SELECT c_last_name, c_first_name, substr(s_city, 1, 30) AS city30, ss_ticket_number, amt, profit
FROM (SELECT ss_ticket_number, ss_customer_sk, s_city, CAST(sum(ss_coupon_amt) AS DECIMAL(38,2)) AS amt,
             CAST(sum(ss_net_profit) AS DECIMAL(38,2)) AS profit
      FROM store_sales, date_dim, store, household_demographics
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_hdemo_sk = hd_demo_sk
        AND (hd_dep_count = $dep OR hd_vehicle_count > 0) AND d_dow = $dow AND d_year IN ($years)
        AND s_number_employees BETWEEN $emp_lo AND $emp_hi
      GROUP BY ss_ticket_number, ss_customer_sk, ss_addr_sk, s_city) ms, customer
WHERE ss_customer_sk = c_customer_sk
ORDER BY c_last_name NULLS LAST, c_first_name NULLS LAST, city30 NULLS LAST, profit NULLS LAST, ss_ticket_number, amt
LIMIT 100
