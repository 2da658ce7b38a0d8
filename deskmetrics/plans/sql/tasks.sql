-- The whole task table.
SELECT * FROM desk_tasks
