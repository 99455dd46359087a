"""Readers: Parquet tables, landed tick folders, CSV / pipe text, Kafka."""
