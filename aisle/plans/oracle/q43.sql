SELECT s_store_name, s_store_id,
  CAST(sum(CASE WHEN d_day_name = 'Sunday' THEN ss_sales_price END) AS DECIMAL(38,2)) AS sun_sales,
  CAST(sum(CASE WHEN d_day_name = 'Monday' THEN ss_sales_price END) AS DECIMAL(38,2)) AS mon_sales,
  CAST(sum(CASE WHEN d_day_name = 'Tuesday' THEN ss_sales_price END) AS DECIMAL(38,2)) AS tue_sales,
  CAST(sum(CASE WHEN d_day_name = 'Wednesday' THEN ss_sales_price END) AS DECIMAL(38,2)) AS wed_sales,
  CAST(sum(CASE WHEN d_day_name = 'Thursday' THEN ss_sales_price END) AS DECIMAL(38,2)) AS thu_sales,
  CAST(sum(CASE WHEN d_day_name = 'Friday' THEN ss_sales_price END) AS DECIMAL(38,2)) AS fri_sales,
  CAST(sum(CASE WHEN d_day_name = 'Saturday' THEN ss_sales_price END) AS DECIMAL(38,2)) AS sat_sales
FROM store_sales
JOIN date_dim ON d_date_sk = ss_sold_date_sk
JOIN store ON s_store_sk = ss_store_sk
WHERE s_gmt_offset = $gmt AND d_year = $year
GROUP BY s_store_name, s_store_id
ORDER BY s_store_name NULLS LAST, s_store_id NULLS LAST, sun_sales NULLS LAST, mon_sales NULLS LAST,
         tue_sales NULLS LAST, wed_sales NULLS LAST, thu_sales NULLS LAST, fri_sales NULLS LAST, sat_sales NULLS LAST
LIMIT 100
