, inv AS (
  SELECT w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy, stdev, mean, mean4,
         CASE mean WHEN 0 THEN NULL ELSE stdev / mean END AS cov
  FROM (SELECT w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy, stddev_samp(inv_quantity_on_hand) AS stdev,
               avg(inv_quantity_on_hand) AS mean,
               round(CAST(sum(inv_quantity_on_hand) * 10000 AS DOUBLE) / count(inv_quantity_on_hand)) / 10000 AS mean4
        FROM inventory, item, warehouse, date_dim
        WHERE inv_item_sk = i_item_sk AND inv_warehouse_sk = w_warehouse_sk AND inv_date_sk = d_date_sk AND d_year = $year
        GROUP BY w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy) foo
  WHERE CASE mean WHEN 0 THEN 0 ELSE stdev / mean END > 1)
SELECT inv1.w_warehouse_sk AS w_warehouse_sk1, inv1.i_item_sk AS i_item_sk1, inv1.d_moy AS d_moy1,
       inv1.mean4 AS mean1, round(inv1.cov, 4) AS cov1,
       inv2.w_warehouse_sk AS w_warehouse_sk2, inv2.i_item_sk AS i_item_sk2, inv2.d_moy AS d_moy2,
       inv2.mean4 AS mean2, round(inv2.cov, 4) AS cov2
FROM inv inv1, inv inv2
WHERE inv1.i_item_sk = inv2.i_item_sk AND inv1.w_warehouse_sk = inv2.w_warehouse_sk
  AND inv1.d_moy = $moy AND inv2.d_moy = $moy + 1
ORDER BY w_warehouse_sk1, i_item_sk1, d_moy1, mean1, cov1, d_moy2, mean2, cov2
