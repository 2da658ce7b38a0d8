-- New eligible accounts per creation day and the number of eligible accounts with an
-- id up to the day's largest id. The parameter lists the days' largest ids, ascending: they cut the ids into steps, as
-- many as there are days at most. Each account counts once for its step, and a running sum over
-- the steps gives every day its total (no pairwise comparison of accounts, no sort of them).
WITH eligible AS (
  SELECT DISTINCT id, to_date(date_creation) AS data FROM desk_accounts
  WHERE CAST(is_active AS INT) = 1 AND CAST(is_deleted AS INT) = 0 AND date_creation IS NOT NULL AND id IS NOT NULL
),
per_day AS (SELECT data, count(*) AS novas_contas, max(id) AS top FROM eligible GROUP BY data),
per_step AS (
  SELECT step, count(*) AS size FROM (
    SELECT DISTINCT id, aggregate(
      transform(sequence(30, 0, -1), e -> CAST(power(2, e) AS INT)), 0,
      (at, half) -> CASE WHEN coalesce(get(try_cast(split(:day_tops, ',') AS ARRAY<BIGINT>), at + half - 1) < id, false) THEN at + half ELSE at END) AS step
    FROM eligible)
  GROUP BY step
),
steps AS (SELECT get(try_cast(split(:day_tops, ',') AS ARRAY<BIGINT>), step) AS top, sum(size) OVER (ORDER BY step) AS total_contas FROM per_step)
SELECT data, novas_contas, CAST(total_contas AS BIGINT) AS total_contas
FROM per_day JOIN steps USING (top)
