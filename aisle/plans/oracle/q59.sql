, wss AS (SELECT d_week_seq, ss_store_sk,
         sum(CASE WHEN d_day_name = 'Sunday' THEN ss_sales_price END) AS sun_sales,
         sum(CASE WHEN d_day_name = 'Monday' THEN ss_sales_price END) AS mon_sales,
         sum(CASE WHEN d_day_name = 'Tuesday' THEN ss_sales_price END) AS tue_sales,
         sum(CASE WHEN d_day_name = 'Wednesday' THEN ss_sales_price END) AS wed_sales,
         sum(CASE WHEN d_day_name = 'Thursday' THEN ss_sales_price END) AS thu_sales,
         sum(CASE WHEN d_day_name = 'Friday' THEN ss_sales_price END) AS fri_sales,
         sum(CASE WHEN d_day_name = 'Saturday' THEN ss_sales_price END) AS sat_sales
  FROM store_sales, date_dim WHERE d_date_sk = ss_sold_date_sk GROUP BY d_week_seq, ss_store_sk)
SELECT s_store_name1, s_store_id1, d_week_seq1,
       round(CAST(sun_sales1 * 1000000 AS DOUBLE) / CAST(NULLIF(sun_sales2, 0) * 100 AS DOUBLE)) / 10000 AS sun_ratio, round(CAST(mon_sales1 * 1000000 AS DOUBLE) / CAST(NULLIF(mon_sales2, 0) * 100 AS DOUBLE)) / 10000 AS mon_ratio, round(CAST(tue_sales1 * 1000000 AS DOUBLE) / CAST(NULLIF(tue_sales2, 0) * 100 AS DOUBLE)) / 10000 AS tue_ratio, round(CAST(wed_sales1 * 1000000 AS DOUBLE) / CAST(NULLIF(wed_sales2, 0) * 100 AS DOUBLE)) / 10000 AS wed_ratio, round(CAST(thu_sales1 * 1000000 AS DOUBLE) / CAST(NULLIF(thu_sales2, 0) * 100 AS DOUBLE)) / 10000 AS thu_ratio, round(CAST(fri_sales1 * 1000000 AS DOUBLE) / CAST(NULLIF(fri_sales2, 0) * 100 AS DOUBLE)) / 10000 AS fri_ratio, round(CAST(sat_sales1 * 1000000 AS DOUBLE) / CAST(NULLIF(sat_sales2, 0) * 100 AS DOUBLE)) / 10000 AS sat_ratio
FROM (SELECT s_store_name AS s_store_name1, wss.d_week_seq AS d_week_seq1, s_store_id AS s_store_id1,
             sun_sales AS sun_sales1, mon_sales AS mon_sales1, tue_sales AS tue_sales1, wed_sales AS wed_sales1, thu_sales AS thu_sales1, fri_sales AS fri_sales1, sat_sales AS sat_sales1
      FROM wss, store, date_dim d
      WHERE d.d_week_seq = wss.d_week_seq AND ss_store_sk = s_store_sk
        AND d_month_seq BETWEEN $month_seq AND $month_seq + 11) y,
     (SELECT s_store_name AS s_store_name2, wss.d_week_seq AS d_week_seq2, s_store_id AS s_store_id2,
             sun_sales AS sun_sales2, mon_sales AS mon_sales2, tue_sales AS tue_sales2, wed_sales AS wed_sales2, thu_sales AS thu_sales2, fri_sales AS fri_sales2, sat_sales AS sat_sales2
      FROM wss, store, date_dim d
      WHERE d.d_week_seq = wss.d_week_seq AND ss_store_sk = s_store_sk
        AND d_month_seq BETWEEN $month_seq + 12 AND $month_seq + 23) x
WHERE s_store_id1 = s_store_id2 AND d_week_seq1 = d_week_seq2 - 52
ORDER BY s_store_name1 NULLS LAST, s_store_id1 NULLS LAST, d_week_seq1 NULLS LAST,
         sun_ratio, mon_ratio, tue_ratio, wed_ratio, thu_ratio, fri_ratio, sat_ratio
LIMIT 100
