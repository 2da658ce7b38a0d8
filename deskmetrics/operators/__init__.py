"""DataFrame -> DataFrame operators: enrichment joins, grading, worklog, account growth."""
