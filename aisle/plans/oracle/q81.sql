, customer_total_return AS (
  SELECT cr_returning_customer_sk AS ctr_customer_sk, ca_state AS ctr_state, sum(cr_return_amt_inc_tax) AS ctr_total_return
  FROM catalog_returns, date_dim, customer_address
  WHERE cr_returned_date_sk = d_date_sk AND d_year = $year AND cr_returning_addr_sk = ca_address_sk
  GROUP BY cr_returning_customer_sk, ca_state)
SELECT c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, ca_street_type,
       ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, ca_gmt_offset, ca_location_type,
       CAST(ctr_total_return AS DECIMAL(38,2)) AS ctr_total_return
FROM customer_total_return ctr1, customer_address, customer
WHERE ctr1.ctr_total_return > (SELECT avg(ctr_total_return) * $factor FROM customer_total_return ctr2
                               WHERE ctr1.ctr_state = ctr2.ctr_state)
  AND ca_address_sk = c_current_addr_sk AND ca_state = '$state' AND ctr1.ctr_customer_sk = c_customer_sk
ORDER BY c_customer_id NULLS LAST, c_salutation NULLS LAST, c_first_name NULLS LAST, c_last_name NULLS LAST,
         ca_street_number NULLS LAST, ca_street_name NULLS LAST, ca_street_type NULLS LAST, ca_suite_number NULLS LAST,
         ca_city NULLS LAST, ca_county NULLS LAST, ca_state NULLS LAST, ca_zip NULLS LAST, ca_country NULLS LAST,
         ca_gmt_offset NULLS LAST, ca_location_type NULLS LAST, ctr_total_return NULLS LAST
LIMIT 100
