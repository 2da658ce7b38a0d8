-- Finished tickets of the period, one row per assigned user and eligible observer
-- (groups 1 and 2, user 6 excluded, name present). Category means and observers use
-- the window from January 1 of the previous year to the final date. Both fan-outs are an inner and an
-- anti join; the second one's key is text, which gives it exchanges of its own, so a hot ticket can be
-- split in both.
WITH means AS (
  SELECT itilcategories_id AS category,
         avg(close_delay_stat) AS tempo_medio_fechamento, avg(solve_delay_stat) AS tempo_medio_solucao
  FROM desk_tickets LEFT SEMI JOIN desk_categories ON desk_categories.id = itilcategories_id
  WHERE to_date(date) BETWEEN :first_day AND :final_date
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
),
watchers AS (
  SELECT DISTINCT CAST(tickets_id AS STRING) AS watched, firstname
  FROM desk_tickets_users
  JOIN (SELECT id AS user_id, firstname FROM desk_users
        WHERE groups_id IN (1, 2) AND id <> 6 AND firstname IS NOT NULL) ON user_id = users_id
  LEFT SEMI JOIN (SELECT id FROM desk_tickets WHERE to_date(date) BETWEEN :first_day AND :final_date) ON id = tickets_id
  WHERE type = 3
),
seen AS (
  SELECT named.*, firstname AS nome_observador FROM named JOIN watchers ON watched = CAST(id AS STRING)
  UNION ALL
  SELECT *, CAST(NULL AS STRING)
  FROM named LEFT ANTI JOIN (SELECT DISTINCT watched FROM watchers) ON watched = CAST(id AS STRING)
)
SELECT seen.*, desk_categories.name AS nome_categoria, desk_request_types.name AS origem,
       tempo_medio_fechamento, tempo_medio_solucao
FROM seen
LEFT JOIN desk_categories ON desk_categories.id = itilcategories_id
LEFT JOIN desk_request_types ON desk_request_types.id = requesttypes_id
LEFT JOIN means ON category = itilcategories_id
