SELECT count(*) AS cnt
FROM store_sales
JOIN household_demographics ON ss_hdemo_sk = hd_demo_sk
JOIN time_dim ON ss_sold_time_sk = t_time_sk
JOIN store ON ss_store_sk = s_store_sk
WHERE t_hour = $hour AND t_minute >= $minute AND hd_dep_count = $dep_count AND s_store_name = '$store_name'
ORDER BY cnt
LIMIT 100
