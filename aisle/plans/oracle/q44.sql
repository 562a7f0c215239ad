, per AS (SELECT ss_item_sk AS item_sk, avg(ss_net_profit) AS rank_col FROM store_sales
          WHERE ss_store_sk = $store_sk GROUP BY ss_item_sk
          HAVING avg(ss_net_profit) > 0.9 * (SELECT avg(ss_net_profit) FROM store_sales
                                             WHERE ss_store_sk = $store_sk AND ss_hdemo_sk IS NULL
                                             GROUP BY ss_store_sk)),
asceding AS (SELECT * FROM (SELECT item_sk, rank() OVER (ORDER BY rank_col ASC) AS rnk FROM per) v WHERE rnk < $k + 1),
descending AS (SELECT * FROM (SELECT item_sk, rank() OVER (ORDER BY rank_col DESC) AS rnk FROM per) v WHERE rnk < $k + 1)
SELECT a.rnk, i1.i_product_name AS best_performing, i2.i_product_name AS worst_performing
FROM asceding a JOIN descending d ON a.rnk = d.rnk
JOIN item i1 ON i1.i_item_sk = a.item_sk
JOIN item i2 ON i2.i_item_sk = d.item_sk
ORDER BY a.rnk NULLS LAST, best_performing, worst_performing
LIMIT 100
