SELECT CAST(sum(ws_ext_discount_amt) AS DECIMAL(38,2)) AS "Excess Discount Amount"
FROM web_sales, item, date_dim
WHERE i_manufact_id = $manufact_id AND i_item_sk = ws_item_sk
  AND d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 90
  AND d_date_sk = ws_sold_date_sk
  AND ws_ext_discount_amt > (SELECT $factor * avg(ws_ext_discount_amt) FROM web_sales, date_dim
                             WHERE ws_item_sk = i_item_sk
                               AND d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 90
                               AND d_date_sk = ws_sold_date_sk)
LIMIT 100
