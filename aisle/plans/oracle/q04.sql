, year_total AS (
  SELECT c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login, c_email_address, d_year AS dyear, sum(((ss_ext_list_price - ss_ext_wholesale_cost - ss_ext_discount_amt) + ss_ext_sales_price) / 2) AS year_total, 's' AS sale_type
  FROM customer, store_sales, date_dim
  WHERE c_customer_sk = ss_customer_sk AND ss_sold_date_sk = d_date_sk
  GROUP BY c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login, c_email_address, d_year
  UNION ALL
  SELECT c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login, c_email_address, d_year AS dyear, sum(((cs_ext_list_price - cs_ext_wholesale_cost - cs_ext_discount_amt) + cs_ext_sales_price) / 2) AS year_total, 'c' AS sale_type
  FROM customer, catalog_sales, date_dim
  WHERE c_customer_sk = cs_bill_customer_sk AND cs_sold_date_sk = d_date_sk
  GROUP BY c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login, c_email_address, d_year
  UNION ALL
  SELECT c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login, c_email_address, d_year AS dyear, sum(((ws_ext_list_price - ws_ext_wholesale_cost - ws_ext_discount_amt) + ws_ext_sales_price) / 2) AS year_total, 'w' AS sale_type
  FROM customer, web_sales, date_dim
  WHERE c_customer_sk = ws_bill_customer_sk AND ws_sold_date_sk = d_date_sk
  GROUP BY c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login, c_email_address, d_year)
SELECT t_s_secyear.c_preferred_cust_flag AS customer_preferred_cust_flag
FROM year_total t_s_firstyear, year_total t_s_secyear, year_total t_c_firstyear, year_total t_c_secyear, year_total t_w_firstyear, year_total t_w_secyear
WHERE t_s_firstyear.c_customer_id = t_s_firstyear.c_customer_id
  AND t_s_secyear.c_customer_id = t_s_firstyear.c_customer_id
  AND t_s_firstyear.sale_type = 's' AND t_s_secyear.sale_type = 's'
  AND t_s_firstyear.dyear = $year AND t_s_secyear.dyear = $year + 1
  AND t_s_firstyear.year_total > 0
  AND t_c_firstyear.c_customer_id = t_s_firstyear.c_customer_id
  AND t_c_secyear.c_customer_id = t_s_firstyear.c_customer_id
  AND t_c_firstyear.sale_type = 'c' AND t_c_secyear.sale_type = 'c'
  AND t_c_firstyear.dyear = $year AND t_c_secyear.dyear = $year + 1
  AND t_c_firstyear.year_total > 0
  AND t_w_firstyear.c_customer_id = t_s_firstyear.c_customer_id
  AND t_w_secyear.c_customer_id = t_s_firstyear.c_customer_id
  AND t_w_firstyear.sale_type = 'w' AND t_w_secyear.sale_type = 'w'
  AND t_w_firstyear.dyear = $year AND t_w_secyear.dyear = $year + 1
  AND t_w_firstyear.year_total > 0
  AND CASE WHEN t_c_firstyear.year_total > 0 THEN t_c_secyear.year_total / t_c_firstyear.year_total ELSE NULL END > CASE WHEN t_s_firstyear.year_total > 0 THEN t_s_secyear.year_total / t_s_firstyear.year_total ELSE NULL END
  AND CASE WHEN t_c_firstyear.year_total > 0 THEN t_c_secyear.year_total / t_c_firstyear.year_total ELSE NULL END > CASE WHEN t_w_firstyear.year_total > 0 THEN t_w_secyear.year_total / t_w_firstyear.year_total ELSE NULL END
ORDER BY 1 NULLS LAST
LIMIT 100
