"""Queries over the shared Parquet tables and the SQL they are checked against."""
