"""Driver catalogue: derived inputs, the queries over them and their DuckDB counterparts."""
