"""Composite jobs, the query catalog and the DuckDB oracle texts."""
