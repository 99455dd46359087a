"""File readers: landed tick folders, CSV with a schema, master dumps, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweave.schemas import MASTER_TEXT
from tickweave.sinks.files import TIME_OPTIONS


def read_landed(spark: SparkSession, root: str, day: str | None = None,
                schema: StructType | None = None) -> DataFrame:
    """Landed Parquet ticks, partitioned by ``ingest_date`` (``yyyy_MM_dd``).

    Reading the folder (not part files) honours the streaming sink's commit
    log; a ``day`` filter prunes partitions instead of building paths.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(root)
    return df.where(F.col("ingest_date") == day) if day else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass over the data)."""
    return (spark.read.schema(schema).options(**TIME_OPTIONS).option("header", header)
            .option("mode", "PERMISSIVE").csv(path))


def read_master_dump(spark: SparkSession, path: str) -> DataFrame:
    """Instrument-master dump: one record per line, 23 ``|``-separated text fields.

    Short rows are filled with NULL at the end (futures rows lack two fields).
    """
    return (spark.read.schema(MASTER_TEXT).option("sep", "|").option("header", False)
            .option("mode", "PERMISSIVE").option("quote", "\u0000").csv(path))


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**TIME_OPTIONS).json(path)


# Bar table as exported to CSV (keys, bar times, OHLC, volume, tick count).
BAR_CSV_SCHEMA = ("instrument bigint, bar_start timestamp_ntz, bar_end timestamp_ntz, open double, "
                  "high double, low double, close double, volume double, ticks bigint")


def read_bar_csv(spark: SparkSession, path: str, schema: str = BAR_CSV_SCHEMA) -> DataFrame:
    """A bar table exported as CSV with a header (paths are arguments, not fixed)."""
    return read_csv(spark, path, schema)
