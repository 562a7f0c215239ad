SELECT s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number,
       s_city, s_county, s_state, s_zip,
  CAST(sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk <= 30 THEN 1 ELSE 0 END) AS BIGINT) AS "30 days",
  CAST(sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 30 AND sr_returned_date_sk - ss_sold_date_sk <= 60
           THEN 1 ELSE 0 END) AS BIGINT) AS "31-60 days",
  CAST(sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 60 AND sr_returned_date_sk - ss_sold_date_sk <= 90
           THEN 1 ELSE 0 END) AS BIGINT) AS "61-90 days",
  CAST(sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 90 AND sr_returned_date_sk - ss_sold_date_sk <= 120
           THEN 1 ELSE 0 END) AS BIGINT) AS "91-120 days",
  CAST(sum(CASE WHEN sr_returned_date_sk - ss_sold_date_sk > 120 THEN 1 ELSE 0 END) AS BIGINT) AS ">120 days"
FROM store_sales
JOIN store_returns ON ss_ticket_number = sr_ticket_number AND ss_item_sk = sr_item_sk AND ss_customer_sk = sr_customer_sk
JOIN date_dim d1 ON ss_sold_date_sk = d1.d_date_sk
JOIN date_dim d2 ON sr_returned_date_sk = d2.d_date_sk
JOIN store ON ss_store_sk = s_store_sk
WHERE d2.d_year = $year AND d2.d_moy = $moy
GROUP BY s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number,
         s_city, s_county, s_state, s_zip
ORDER BY s_store_name NULLS LAST, s_company_id NULLS LAST, s_street_number NULLS LAST, s_street_name NULLS LAST,
         s_street_type NULLS LAST, s_suite_number NULLS LAST, s_city NULLS LAST, s_county NULLS LAST,
         s_state NULLS LAST, s_zip NULLS LAST, "30 days", "31-60 days", "61-90 days", "91-120 days", ">120 days"
LIMIT 100
