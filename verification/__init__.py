"""The registered queries over the sample tables and their DuckDB twins."""
