"""Input views over the test tables, registered queries and their DuckDB twins."""
