"""DuckDB statements that answer the registered queries independently."""
