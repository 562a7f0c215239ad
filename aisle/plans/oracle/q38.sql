SELECT count(*) AS cnt FROM (
  SELECT DISTINCT c_last_name, c_first_name, d_date
    FROM store_sales, date_dim, customer
    WHERE ss_sold_date_sk = d_date_sk AND ss_customer_sk = c_customer_sk
      AND d_month_seq BETWEEN $month_seq AND $month_seq + 11
  INTERSECT
  SELECT DISTINCT c_last_name, c_first_name, d_date
    FROM catalog_sales, date_dim, customer
    WHERE cs_sold_date_sk = d_date_sk AND cs_bill_customer_sk = c_customer_sk
      AND d_month_seq BETWEEN $month_seq AND $month_seq + 11
  INTERSECT
  SELECT DISTINCT c_last_name, c_first_name, d_date
    FROM web_sales, date_dim, customer
    WHERE ws_sold_date_sk = d_date_sk AND ws_bill_customer_sk = c_customer_sk
      AND d_month_seq BETWEEN $month_seq AND $month_seq + 11
) hot_cust
LIMIT 100
