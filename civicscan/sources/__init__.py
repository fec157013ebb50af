"""Table sources: driver parquet tables, fixture views, CSV readers and sinks."""
