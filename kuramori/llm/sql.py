"""DuckDB counterparts of the queries in this subpackage that SQL can express."""

SQL: dict[str, str] = {}
