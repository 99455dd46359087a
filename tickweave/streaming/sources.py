"""Streaming sources: Kafka topics and file folders carrying the same payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                 fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """One Kafka topic as a stream of (key, value bytes, topic, partition, offset, timestamp).

    Needs the Kafka connector on the classpath (given at submit time, matched to
    the cluster's Spark and Scala versions). ``fail_on_data_loss`` is explicit:
    set it to False only where lost offsets are acceptable.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def file_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                recursive: bool = False) -> DataFrame:
    """Files appearing in a folder as a stream (used where no broker is at hand)."""
    r = spark.readStream.format(fmt).schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(folder)
