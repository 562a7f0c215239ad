SELECT * FROM (
  SELECT CAST(sum(ss_net_profit) AS DECIMAL(38,2)) AS total_sum, s_state, s_county,
         CAST(grouping(s_state) + grouping(s_county) AS INT) AS lochierarchy,
         rank() OVER (PARTITION BY grouping(s_state) + grouping(s_county),
                      CASE WHEN grouping(s_county) = 0 THEN s_state END
                      ORDER BY sum(ss_net_profit) DESC) AS rank_within_parent
  FROM store_sales, date_dim d1, store
  WHERE d1.d_month_seq BETWEEN $month_seq AND $month_seq + 11 AND d1.d_date_sk = ss_sold_date_sk
    AND s_store_sk = ss_store_sk
    AND s_state IN (SELECT s_state FROM (
          SELECT s_state, rank() OVER (PARTITION BY s_state ORDER BY sum(ss_net_profit) DESC) AS ranking
          FROM store_sales, store, date_dim
          WHERE d_month_seq BETWEEN $month_seq AND $month_seq + 11 AND d_date_sk = ss_sold_date_sk
            AND s_store_sk = ss_store_sk
          GROUP BY s_state) tmp1 WHERE ranking <= $k)
  GROUP BY ROLLUP (s_state, s_county)) sub
ORDER BY lochierarchy DESC NULLS FIRST, CASE WHEN lochierarchy = 0 THEN s_state END NULLS LAST,
         rank_within_parent NULLS LAST, total_sum, s_state, s_county
LIMIT 100
