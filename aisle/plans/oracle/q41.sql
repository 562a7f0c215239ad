SELECT DISTINCT i_product_name
FROM item i1
WHERE i_manufact_id BETWEEN $manufact_lo AND $manufact_lo + $span
  AND (SELECT count(*) AS item_cnt FROM item
       WHERE i_manufact = i1.i_manufact AND (
   (i_category = 'Women' AND (i_color = 'purple' OR i_color = 'pale') AND (i_units = 'Bunch' OR i_units = 'Lb') AND (i_size = 'large' OR i_size = 'petite'))
   OR (i_category = 'Women' AND (i_color = 'floral' OR i_color = 'chiffon') AND (i_units = 'Gross' OR i_units = 'Box') AND (i_size = 'N/A' OR i_size = 'extra large'))
   OR (i_category = 'Men' AND (i_color = 'burnished' OR i_color = 'slate') AND (i_units = 'Dozen' OR i_units = 'Case') AND (i_size = 'large' OR i_size = 'small'))
   OR (i_category = 'Men' AND (i_color = 'medium' OR i_color = 'indian') AND (i_units = 'Oz' OR i_units = 'Each') AND (i_size = 'small' OR i_size = 'medium'))
   OR (i_category = 'Women' AND (i_color = 'aquamarine' OR i_color = 'burlywood') AND (i_units = 'Lb' OR i_units = 'Oz') AND (i_size = 'petite' OR i_size = 'medium'))
   OR (i_category = 'Women' AND (i_color = 'spring' OR i_color = 'slate') AND (i_units = 'Case' OR i_units = 'Dozen') AND (i_size = 'N/A' OR i_size = 'extra large'))
   OR (i_category = 'Men' AND (i_color = 'blanched' OR i_color = 'pale') AND (i_units = 'Bunch' OR i_units = 'Each') AND (i_size = 'small' OR i_size = 'large'))
   OR (i_category = 'Men' AND (i_color = 'burlywood' OR i_color = 'aquamarine') AND (i_units = 'Gross' OR i_units = 'Bunch') AND (i_size = 'petite' OR i_size = 'medium')))) > 0
ORDER BY i_product_name NULLS LAST
LIMIT 100
