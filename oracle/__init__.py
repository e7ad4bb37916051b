"""DuckDB-runnable SQL twins of the registered Spark queries."""
