"""DuckDB statements that give the expected result of every query, written apart from the library."""
