"""Data operators for tables and streams, written on Spark SQL and Structured Streaming."""
