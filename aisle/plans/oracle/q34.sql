SELECT c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number, cnt
FROM (SELECT ss_ticket_number, ss_customer_sk, count(*) AS cnt
      FROM store_sales, date_dim, store, household_demographics
      WHERE ss_sold_date_sk = d_date_sk AND ss_store_sk = s_store_sk AND ss_hdemo_sk = hd_demo_sk
        AND (d_dom BETWEEN 1 AND 3 OR d_dom BETWEEN 25 AND 28) AND hd_buy_potential IN ($potentials) AND hd_vehicle_count > 0
        AND (CASE WHEN hd_vehicle_count > 0 THEN hd_dep_count // hd_vehicle_count ELSE NULL END) > $ratio
        AND d_year IN ($years) AND s_county IN ($counties)
      GROUP BY ss_ticket_number, ss_customer_sk) dn, customer
WHERE ss_customer_sk = c_customer_sk AND cnt BETWEEN $lo AND $hi
ORDER BY c_last_name NULLS LAST, c_first_name NULLS LAST, c_salutation NULLS LAST, c_preferred_cust_flag DESC NULLS FIRST
