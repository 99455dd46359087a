"""Writers: landed Parquet, CSV exports, JSON lines, tables, Kafka, JDBC."""
