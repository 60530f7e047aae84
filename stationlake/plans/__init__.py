"""The daily job and the registered query catalogue (Spark side and DuckDB oracle side)."""
