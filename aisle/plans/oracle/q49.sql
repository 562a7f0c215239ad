SELECT 'web' AS channel, item, shown AS return_ratio, return_rank, currency_rank
FROM (SELECT item, shown, return_ratio, currency_ratio,
             rank() OVER (ORDER BY return_ratio) AS return_rank,
             rank() OVER (ORDER BY currency_ratio) AS currency_rank
      FROM (SELECT ws.ws_item_sk AS item,
                   CAST(sum(coalesce(wr.wr_return_quantity, 0)) AS DECIMAL(15,4))
                     / CAST(sum(coalesce(ws.ws_quantity, 0)) AS DECIMAL(15,4)) AS return_ratio,
                   round(CAST(sum(coalesce(wr.wr_return_quantity, 0)) * 10000 AS DOUBLE) / sum(coalesce(ws.ws_quantity, 0))) / 10000 AS shown,
                   CAST(sum(coalesce(wr.wr_return_amt, 0)) AS DECIMAL(15,4))
                     / CAST(sum(coalesce(ws.ws_net_paid, 0)) AS DECIMAL(15,4)) AS currency_ratio
            FROM web_sales ws
            LEFT OUTER JOIN web_returns wr
              ON ws.ws_order_number = wr.wr_order_number AND ws.ws_item_sk = wr.wr_item_sk
            JOIN date_dim ON ws_sold_date_sk = d_date_sk
            WHERE wr.wr_return_amt > $min_return_amt AND ws.ws_net_profit > 1 AND ws.ws_net_paid > 0
              AND ws.ws_quantity > 0 AND d_year = $year AND d_moy = $moy
            GROUP BY ws.ws_item_sk) x) y
WHERE return_rank <= $k OR currency_rank <= $k
UNION
SELECT 'catalog' AS channel, item, shown AS return_ratio, return_rank, currency_rank
FROM (SELECT item, shown, return_ratio, currency_ratio,
             rank() OVER (ORDER BY return_ratio) AS return_rank,
             rank() OVER (ORDER BY currency_ratio) AS currency_rank
      FROM (SELECT cs.cs_item_sk AS item,
                   CAST(sum(coalesce(cr.cr_return_quantity, 0)) AS DECIMAL(15,4))
                     / CAST(sum(coalesce(cs.cs_quantity, 0)) AS DECIMAL(15,4)) AS return_ratio,
                   round(CAST(sum(coalesce(cr.cr_return_quantity, 0)) * 10000 AS DOUBLE) / sum(coalesce(cs.cs_quantity, 0))) / 10000 AS shown,
                   CAST(sum(coalesce(cr.cr_return_amount, 0)) AS DECIMAL(15,4))
                     / CAST(sum(coalesce(cs.cs_net_paid, 0)) AS DECIMAL(15,4)) AS currency_ratio
            FROM catalog_sales cs
            LEFT OUTER JOIN catalog_returns cr
              ON cs.cs_order_number = cr.cr_order_number AND cs.cs_item_sk = cr.cr_item_sk
            JOIN date_dim ON cs_sold_date_sk = d_date_sk
            WHERE cr.cr_return_amount > $min_return_amt AND cs.cs_net_profit > 1 AND cs.cs_net_paid > 0
              AND cs.cs_quantity > 0 AND d_year = $year AND d_moy = $moy
            GROUP BY cs.cs_item_sk) x) y
WHERE return_rank <= $k OR currency_rank <= $k
UNION
SELECT 'store' AS channel, item, shown AS return_ratio, return_rank, currency_rank
FROM (SELECT item, shown, return_ratio, currency_ratio,
             rank() OVER (ORDER BY return_ratio) AS return_rank,
             rank() OVER (ORDER BY currency_ratio) AS currency_rank
      FROM (SELECT ss.ss_item_sk AS item,
                   CAST(sum(coalesce(sr.sr_return_quantity, 0)) AS DECIMAL(15,4))
                     / CAST(sum(coalesce(ss.ss_quantity, 0)) AS DECIMAL(15,4)) AS return_ratio,
                   round(CAST(sum(coalesce(sr.sr_return_quantity, 0)) * 10000 AS DOUBLE) / sum(coalesce(ss.ss_quantity, 0))) / 10000 AS shown,
                   CAST(sum(coalesce(sr.sr_return_amt, 0)) AS DECIMAL(15,4))
                     / CAST(sum(coalesce(ss.ss_net_paid, 0)) AS DECIMAL(15,4)) AS currency_ratio
            FROM store_sales ss
            LEFT OUTER JOIN store_returns sr
              ON ss.ss_ticket_number = sr.sr_ticket_number AND ss.ss_item_sk = sr.sr_item_sk
            JOIN date_dim ON ss_sold_date_sk = d_date_sk
            WHERE sr.sr_return_amt > $min_return_amt AND ss.ss_net_profit > 1 AND ss.ss_net_paid > 0
              AND ss.ss_quantity > 0 AND d_year = $year AND d_moy = $moy
            GROUP BY ss.ss_item_sk) x) y
WHERE return_rank <= $k OR currency_rank <= $k
ORDER BY 1 NULLS LAST, 4 NULLS LAST, 5 NULLS LAST, 2, 3
LIMIT 100
