SELECT s_store_name, CAST(sum(ss_net_profit) AS DECIMAL(38,2)) AS sum_net_profit
FROM store_sales, date_dim, store,
     (SELECT ca_zip FROM (
        (SELECT substr(ca_zip, 1, 5) AS ca_zip FROM customer_address WHERE substr(ca_zip, 1, 5) IN ($zips))
        INTERSECT
        (SELECT ca_zip FROM (SELECT substr(ca_zip, 1, 5) AS ca_zip, count(*) AS cnt
                             FROM customer_address, customer
                             WHERE ca_address_sk = c_current_addr_sk AND c_preferred_cust_flag = 'Y'
                             GROUP BY ca_zip HAVING count(*) > $min_preferred) a1)) a2) v1
WHERE ss_store_sk = s_store_sk AND ss_sold_date_sk = d_date_sk AND d_qoy = $qoy AND d_year = $year
  AND substr(s_zip, 1, 2) = substr(v1.ca_zip, 1, 2)
GROUP BY s_store_name
ORDER BY s_store_name NULLS LAST, sum_net_profit
LIMIT 100
