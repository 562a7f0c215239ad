, quarters AS (SELECT d_date_sk AS day, d_year, d_qoy FROM date_dim),
kinds AS (SELECT i_item_sk AS good, i_category FROM item),
no_address AS (SELECT d_year, d_qoy, i_category, count(*) AS n, sum(ss_ext_sales_price) AS v
               FROM store_sales JOIN quarters ON day = ss_sold_date_sk JOIN kinds ON good = ss_item_sk
               WHERE ss_addr_sk IS NULL GROUP BY ALL),
no_page AS (SELECT d_year, d_qoy, i_category, count(*) AS n, sum(ws_ext_sales_price) AS v
            FROM web_sales JOIN quarters ON day = ws_sold_date_sk JOIN kinds ON good = ws_item_sk
            WHERE ws_web_page_sk IS NULL GROUP BY ALL),
no_warehouse AS (SELECT d_year, d_qoy, i_category, count(*) AS n, sum(cs_ext_sales_price) AS v
                 FROM catalog_sales JOIN quarters ON day = cs_sold_date_sk JOIN kinds ON good = cs_item_sk
                 WHERE cs_warehouse_sk IS NULL GROUP BY ALL),
labelled AS (SELECT 'store' AS channel, 'ss_addr_sk' AS col_name, * FROM no_address
             UNION ALL SELECT 'web', 'ws_web_page_sk', * FROM no_page
             UNION ALL SELECT 'catalog', 'cs_warehouse_sk', * FROM no_warehouse)
SELECT channel, col_name, d_year, d_qoy, i_category, n AS sales_cnt, CAST(v AS DECIMAL(38,2)) AS sales_amt
FROM labelled
ORDER BY channel, col_name, d_year NULLS LAST, d_qoy NULLS LAST, i_category NULLS LAST, sales_cnt, sales_amt
LIMIT 100
