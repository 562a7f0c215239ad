SELECT *
FROM (SELECT count(*) AS h8_30_to_9 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 8 AND t_minute >= 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h8_30_to_9,
     (SELECT count(*) AS h9_to_9_30 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 9 AND t_minute < 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h9_to_9_30,
     (SELECT count(*) AS h9_30_to_10 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 9 AND t_minute >= 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h9_30_to_10,
     (SELECT count(*) AS h10_to_10_30 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 10 AND t_minute < 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h10_to_10_30,
     (SELECT count(*) AS h10_30_to_11 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 10 AND t_minute >= 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h10_30_to_11,
     (SELECT count(*) AS h11_to_11_30 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 11 AND t_minute < 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h11_to_11_30,
     (SELECT count(*) AS h11_30_to_12 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 11 AND t_minute >= 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h11_30_to_12,
     (SELECT count(*) AS h12_to_12_30 FROM store_sales, household_demographics, time_dim, store
  WHERE ss_sold_time_sk = t_time_sk AND ss_hdemo_sk = hd_demo_sk AND ss_store_sk = s_store_sk
    AND t_hour = 12 AND t_minute < 30 AND ((hd_dep_count = 3 AND hd_vehicle_count <= 3 + 2) OR (hd_dep_count = 0 AND hd_vehicle_count <= 0 + 2) OR (hd_dep_count = 1 AND hd_vehicle_count <= 1 + 2)) AND s_store_name = '$store_name') s_h12_to_12_30
