"""Sinks: partitioned Parquet tables, JDBC append, search index, CSV export."""
