"""Plans: the query catalog, DuckDB oracle texts, and the ordered build."""
