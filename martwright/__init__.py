"""Sales-warehouse operators for PySpark: raw tables to star schema to analytics."""
