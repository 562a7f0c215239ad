SELECT cc_call_center_id AS Call_Center, cc_name AS Call_Center_Name, cc_manager AS Manager,
       CAST(sum(cr_net_loss) AS DECIMAL(38,2)) AS Returns_Loss
FROM call_center, catalog_returns, date_dim, customer, customer_address, customer_demographics, household_demographics
WHERE cr_call_center_sk = cc_call_center_sk AND cr_returned_date_sk = d_date_sk AND cr_returning_customer_sk = c_customer_sk
  AND cd_demo_sk = c_current_cdemo_sk AND hd_demo_sk = c_current_hdemo_sk AND ca_address_sk = c_current_addr_sk
  AND d_year = $year AND d_moy = $moy
  AND ((cd_marital_status = '$m1' AND cd_education_status = '$e1') OR (cd_marital_status = '$m2' AND cd_education_status = '$e2'))
  AND hd_buy_potential LIKE '$potential_prefix%' AND ca_gmt_offset = $gmt
GROUP BY cc_call_center_id, cc_name, cc_manager, cd_marital_status, cd_education_status
ORDER BY Returns_Loss DESC NULLS FIRST
