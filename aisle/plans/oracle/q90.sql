SELECT round(CAST(amc * 10000 AS DOUBLE) / NULLIF(pmc, 0)) / 10000 AS am_pm_ratio
FROM (SELECT count(*) AS amc FROM web_sales, household_demographics, time_dim, web_page
      WHERE ws_sold_time_sk = t_time_sk AND ws_ship_hdemo_sk = hd_demo_sk AND ws_web_page_sk = wp_web_page_sk
        AND t_hour BETWEEN $am_hour AND $am_hour + 1 AND hd_dep_count = $dep
        AND wp_char_count BETWEEN $chars_lo AND $chars_hi) at_,
     (SELECT count(*) AS pmc FROM web_sales, household_demographics, time_dim, web_page
      WHERE ws_sold_time_sk = t_time_sk AND ws_ship_hdemo_sk = hd_demo_sk AND ws_web_page_sk = wp_web_page_sk
        AND t_hour BETWEEN $pm_hour AND $pm_hour + 1 AND hd_dep_count = $dep
        AND wp_char_count BETWEEN $chars_lo AND $chars_hi) pt
ORDER BY am_pm_ratio
LIMIT 100
