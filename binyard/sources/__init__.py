"""Catalogs (Parquet, JDBC, frames), schemas, sinks and the test-data adapter."""
