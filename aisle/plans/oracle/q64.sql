, profitable AS (  -- items whose returned catalog sales list for more than twice their refunds
  SELECT cs_item_sk AS good FROM catalog_sales
  JOIN catalog_returns ON cr_order_number = cs_order_number AND cr_item_sk = cs_item_sk
  GROUP BY good HAVING sum(cs_ext_list_price) > 2 * sum(cr_refunded_cash + cr_reversed_charge + cr_store_credit)),
goods AS (
  SELECT i_item_sk AS good, i_product_name FROM item SEMI JOIN profitable ON good = i_item_sk
  WHERE i_color IN ($colors) AND i_current_price BETWEEN $price + 1 AND $price + 10),
place AS (SELECT ca_address_sk AS place_sk, ca_street_number AS number, ca_street_name AS street, ca_city AS city, ca_zip AS zip
          FROM customer_address),
household AS (SELECT hd_demo_sk AS household_sk FROM household_demographics
              JOIN income_band ON ib_income_band_sk = hd_income_band_sk),
status AS (SELECT cd_demo_sk AS person_sk, cd_marital_status AS marital FROM customer_demographics),
buyer AS (  -- who the customer is now, and when they first bought and were first shipped to
  SELECT c_customer_sk AS buyer_sk, home.* EXCLUDE (place_sk), now.marital AS marital_now,
         bought.d_year AS first_bought, shipped.d_year AS first_shipped
  FROM customer JOIN place home ON home.place_sk = c_current_addr_sk
  JOIN household ON household_sk = c_current_hdemo_sk
  JOIN status now ON now.person_sk = c_current_cdemo_sk
  JOIN date_dim bought ON bought.d_date_sk = c_first_sales_date_sk
  JOIN date_dim shipped ON shipped.d_date_sk = c_first_shipto_date_sk),
yearly AS (
  SELECT good, i_product_name, s_store_name, s_zip, at_sale.number AS n1, at_sale.street AS t1, at_sale.city AS c1,
         at_sale.zip AS z1, buyer.number AS n2, buyer.street AS t2, buyer.city AS c2, buyer.zip AS z2,
         sold.d_year AS yr, first_bought, first_shipped, count(*) AS lines,
         sum(ss_wholesale_cost) AS cost, sum(ss_list_price) AS listed, sum(ss_coupon_amt) AS coupons
  FROM store_sales
  JOIN store_returns ON sr_ticket_number = ss_ticket_number AND sr_item_sk = ss_item_sk
  JOIN goods ON good = ss_item_sk
  JOIN date_dim sold ON sold.d_date_sk = ss_sold_date_sk
  JOIN store ON s_store_sk = ss_store_sk
  JOIN promotion ON p_promo_sk = ss_promo_sk
  JOIN household ON household_sk = ss_hdemo_sk
  JOIN place at_sale ON at_sale.place_sk = ss_addr_sk
  JOIN status then_ ON then_.person_sk = ss_cdemo_sk
  JOIN buyer ON buyer_sk = ss_customer_sk AND marital_now <> then_.marital
  GROUP BY ALL)
SELECT a.i_product_name AS product_name, a.s_store_name AS store_name, a.s_zip AS store_zip,
       a.n1 AS b_street_number, a.t1 AS b_streen_name, a.c1 AS b_city, a.z1 AS b_zip,
       a.n2 AS c_street_number, a.t2 AS c_street_name, a.c2 AS c_city, a.z2 AS c_zip, a.yr AS syear, a.lines AS cnt,
       CAST(a.cost AS DECIMAL(38,2)) AS s1, CAST(a.listed AS DECIMAL(38,2)) AS s2, CAST(a.coupons AS DECIMAL(38,2)) AS s3,
       CAST(b.cost AS DECIMAL(38,2)) AS s1_2, CAST(b.listed AS DECIMAL(38,2)) AS s2_2, CAST(b.coupons AS DECIMAL(38,2)) AS s3_2,
       b.yr AS syear_2, b.lines AS cnt_2
FROM yearly a JOIN yearly b USING (good, s_store_name, s_zip)
WHERE a.yr = $year AND b.yr = a.yr + 1 AND b.lines <= a.lines
ORDER BY product_name NULLS LAST, store_name NULLS LAST, cnt_2
