SELECT CASE WHEN (SELECT count(*) FROM store_sales WHERE ss_quantity BETWEEN 1 AND 20) > $t1
            THEN (SELECT round(CAST(sum(ss_ext_discount_amt) * 10000 AS DOUBLE) / count(ss_ext_discount_amt)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 1 AND 20)
            ELSE (SELECT round(CAST(sum($value_col) * 10000 AS DOUBLE) / count($value_col)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 1 AND 20) END AS bucket1,
       CASE WHEN (SELECT count(*) FROM store_sales WHERE ss_quantity BETWEEN 21 AND 40) > $t2
            THEN (SELECT round(CAST(sum(ss_ext_discount_amt) * 10000 AS DOUBLE) / count(ss_ext_discount_amt)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 21 AND 40)
            ELSE (SELECT round(CAST(sum($value_col) * 10000 AS DOUBLE) / count($value_col)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 21 AND 40) END AS bucket2,
       CASE WHEN (SELECT count(*) FROM store_sales WHERE ss_quantity BETWEEN 41 AND 60) > $t3
            THEN (SELECT round(CAST(sum(ss_ext_discount_amt) * 10000 AS DOUBLE) / count(ss_ext_discount_amt)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 41 AND 60)
            ELSE (SELECT round(CAST(sum($value_col) * 10000 AS DOUBLE) / count($value_col)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 41 AND 60) END AS bucket3,
       CASE WHEN (SELECT count(*) FROM store_sales WHERE ss_quantity BETWEEN 61 AND 80) > $t4
            THEN (SELECT round(CAST(sum(ss_ext_discount_amt) * 10000 AS DOUBLE) / count(ss_ext_discount_amt)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 61 AND 80)
            ELSE (SELECT round(CAST(sum($value_col) * 10000 AS DOUBLE) / count($value_col)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 61 AND 80) END AS bucket4,
       CASE WHEN (SELECT count(*) FROM store_sales WHERE ss_quantity BETWEEN 81 AND 100) > $t5
            THEN (SELECT round(CAST(sum(ss_ext_discount_amt) * 10000 AS DOUBLE) / count(ss_ext_discount_amt)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 81 AND 100)
            ELSE (SELECT round(CAST(sum($value_col) * 10000 AS DOUBLE) / count($value_col)) / 10000 FROM store_sales WHERE ss_quantity BETWEEN 81 AND 100) END AS bucket5
FROM reason
WHERE r_reason_sk = 1
