-- Finished tickets of the period, one row per assigned user, with category, weight,
-- origin, the user's first name and last year's mean close and solve seconds of the
-- ticket's category (none for categories that the category table lacks). Assignees are attached by an
-- inner join and tickets without one by an anti join, so a hot ticket can be split on either side.
WITH means AS (
  SELECT itilcategories_id AS category,
         avg(close_delay_stat) AS tempo_medio_fechamento, avg(solve_delay_stat) AS tempo_medio_solucao
  FROM desk_tickets LEFT SEMI JOIN desk_categories ON desk_categories.id = itilcategories_id
  WHERE to_date(date) BETWEEN :first_day AND :last_day
  GROUP BY itilcategories_id
),
finished AS (
  SELECT * FROM desk_tickets WHERE status IN (5, 6) AND to_date(date) BETWEEN :initial_date AND :final_date
),
staff AS (
  SELECT tickets_id AS item, firstname
  FROM desk_tickets_users LEFT JOIN desk_users ON desk_users.id = users_id
  WHERE type = 2
),
named AS (
  SELECT finished.*, firstname AS nome_tecnico FROM finished JOIN staff ON item = id
  UNION ALL
  SELECT *, CAST(NULL AS STRING) FROM finished LEFT ANTI JOIN (SELECT DISTINCT item FROM staff) ON item = id
)
SELECT named.* EXCEPT (nome_tecnico), desk_categories.name AS nome_categoria, pesofield AS peso,
       desk_request_types.name AS origem, nome_tecnico, tempo_medio_fechamento, tempo_medio_solucao
FROM named
LEFT JOIN desk_categories ON desk_categories.id = itilcategories_id
LEFT JOIN desk_category_weights ON items_id = itilcategories_id
LEFT JOIN desk_request_types ON desk_request_types.id = requesttypes_id
LEFT JOIN means ON category = itilcategories_id
