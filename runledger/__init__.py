"""SQL statements as recorded Spark runs, and queries over the run log."""
