SELECT i_item_id, i_item_desc, i_current_price
FROM item, inventory, date_dim, catalog_sales
WHERE i_current_price BETWEEN $lo_price AND $lo_price + 30 AND inv_item_sk = i_item_sk AND d_date_sk = inv_date_sk
  AND d_date BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 60
  AND i_manufact_id IN ($manufacts) AND inv_quantity_on_hand BETWEEN 100 AND 500 AND cs_item_sk = i_item_sk
GROUP BY i_item_id, i_item_desc, i_current_price
ORDER BY i_item_id NULLS LAST, i_item_desc, i_current_price
LIMIT 100
