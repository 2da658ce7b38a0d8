-- Time worked per (ticket, task technician, end day) for timers that begin and end in
-- the window, tasks with a technician. Timers are summed per group before the
-- assignees are counted; each assignee of a ticket repeats its time, so the sums are
-- multiplied by the number of assignee rows (1 when there is none). The assignees' key is text, which
-- gives that join exchanges of its own, so a hot ticket can be split in both joins.
WITH work AS (
  SELECT tickets_id, users_id_tech, to_date(actual_end) AS ultima_modificacao, min(to_date(date)) AS data_tarefa,
         sum(actual_actiontime) AS timed, sum(actiontime) AS noted
  FROM desk_timers JOIN desk_tasks ON desk_tasks.id = tasks_id
  WHERE users_id_tech <> 0
    AND to_date(actual_begin) BETWEEN :initial_date AND :final_date
    AND to_date(actual_end) BETWEEN :initial_date AND :final_date
  GROUP BY tickets_id, users_id_tech, to_date(actual_end)
),
staff AS (
  SELECT CAST(tickets_id AS STRING) AS item, count(*) AS n, min(firstname) AS tecnico_do_chamado
  FROM desk_tickets_users LEFT JOIN desk_users ON desk_users.id = users_id
  WHERE type = 2
  GROUP BY CAST(tickets_id AS STRING)
)
SELECT tickets_id AS id, data_tarefa, ultima_modificacao, tecnico_do_chamado,
       desk_users.firstname AS tecnico_das_tarefas, desk_categories.name AS categoria_chamado,
       timed * coalesce(n, 1) AS tempo_via_plugin, noted * coalesce(n, 1) AS tempo_via_glpi
FROM work
JOIN (SELECT id AS ticket, itilcategories_id FROM desk_tickets) ON ticket = tickets_id
LEFT JOIN staff ON item = CAST(tickets_id AS STRING)
LEFT JOIN desk_categories ON desk_categories.id = itilcategories_id
LEFT JOIN desk_users ON desk_users.id = users_id_tech
