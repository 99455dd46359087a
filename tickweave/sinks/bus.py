"""Bus (Kafka) and warehouse (JDBC) writers.

The record shaping (key / value / topic columns) is plain DataFrame code and
is tested; the connectors themselves need their jars and a reachable service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_records(df: DataFrame, key_cols, value_cols=None, topic_col: str | None = None,
                  topic: str | None = None) -> DataFrame:
    """(key, value[, topic]) text columns: key = instrument so that per-instrument
    order is kept within a Kafka partition; value = JSON of the row."""
    key = F.concat_ws("_", *[F.col(c).cast("string") for c in key_cols])
    value = F.to_json(F.struct(*[F.col(c) for c in (value_cols or df.columns)]))
    cols = [key.alias("key"), value.alias("value")]
    if topic_col:
        cols.append(F.col(topic_col).alias("topic"))
    elif topic:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)


def write_kafka(records: DataFrame, servers: str, checkpoint: str | None = None):
    """Batch or streaming write of :func:`kafka_records` output (topic per row)."""
    if records.isStreaming:
        return (records.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("checkpointLocation", checkpoint).start())
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    return None


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", num_partitions: int | None = None):
    """Load curated rows into a warehouse table over JDBC (parallel per partition)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.mode(mode).jdbc(url, table, properties=properties or {})
