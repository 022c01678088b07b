"""Financial reporting on Spark: ledgers, statements, quality checks, streams."""
