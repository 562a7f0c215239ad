, stock AS (
  SELECT i_product_name, i_brand, i_class, i_category, CAST(sum(inv_quantity_on_hand) AS DOUBLE) / count(inv_quantity_on_hand) AS mean,
         round(CAST(sum(inv_quantity_on_hand) * 10000 AS DOUBLE) / count(inv_quantity_on_hand)) / 10000 AS mean4
  FROM inventory JOIN warehouse ON w_warehouse_sk = inv_warehouse_sk JOIN item ON i_item_sk = inv_item_sk
  JOIN date_dim ON d_date_sk = inv_date_sk AND d_month_seq - $month_seq BETWEEN 0 AND 11
  GROUP BY ROLLUP (i_product_name, i_brand, i_class, i_category)
  ORDER BY mean NULLS LAST, i_product_name NULLS LAST, i_brand NULLS LAST, i_class NULLS LAST, i_category NULLS LAST
  LIMIT 100)
SELECT i_product_name, i_brand, i_class, i_category, mean4 AS qoh FROM stock
