-- Finished changes of the period, one row per assigned user, with that user's first
-- name, the category name and the category weight. Assignees are attached by an inner join and
-- items without one by an anti join, so a hot item can be split on either side.
WITH finished AS (
  SELECT * FROM desk_changes WHERE status IN (5, 6) AND to_date(date) BETWEEN :initial_date AND :final_date
),
staff AS (
  SELECT changes_id AS item, firstname
  FROM desk_changes_users LEFT JOIN desk_users ON desk_users.id = users_id
  WHERE type = 2
),
named AS (
  SELECT finished.*, firstname AS nome_tecnico FROM finished JOIN staff ON item = id
  UNION ALL
  SELECT *, CAST(NULL AS STRING) FROM finished LEFT ANTI JOIN (SELECT DISTINCT item FROM staff) ON item = id
)
SELECT named.*, desk_categories.name AS nome_categoria, pesofield AS peso
FROM named
LEFT JOIN desk_categories ON desk_categories.id = itilcategories_id
LEFT JOIN desk_category_weights ON items_id = itilcategories_id
