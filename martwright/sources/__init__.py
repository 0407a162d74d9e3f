"""Reading and writing: JDBC, Parquet tables, batch ingestion."""
