"""DataFrame operators: merges, star schema, reports, statements, run log, quality."""
