SELECT CAST(sum(cs_ext_discount_amt) AS DECIMAL(38,2)) AS "excess discount amount"
FROM catalog_sales, item, date_dim
WHERE i_manufact_id = $manufact_id AND i_item_sk = cs_item_sk
  AND d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 90
  AND d_date_sk = cs_sold_date_sk
  AND cs_ext_discount_amt > (SELECT $factor * avg(cs_ext_discount_amt) FROM catalog_sales, date_dim
                             WHERE cs_item_sk = i_item_sk
                               AND d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 90
                               AND d_date_sk = cs_sold_date_sk)
LIMIT 100
