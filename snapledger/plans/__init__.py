"""The query catalogue: name -> Spark plan, and name -> SQL for the check in DuckDB."""
