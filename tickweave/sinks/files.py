"""Batch file writers. All writes are distributed (one file per task); nothing
passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Text formats keep full microsecond precision (the default writes milliseconds).
TIME_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One text line per row (a single string column)."""
    lines.write.mode(mode).text(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> str:
    """CSV export with a header; overwrite replaces the folder atomically per job."""
    df.write.mode(mode).options(**TIME_OPTIONS).option("header", header).csv(path)
    return path


def append_json_lines(df: DataFrame, path: str) -> str:
    """Append rows as JSON lines (one object per line)."""
    df.write.mode("append").options(**TIME_OPTIONS).json(path)
    return path


def cluster_for_partitioned_write(df: DataFrame, partition_by, order=()) -> DataFrame:
    """Range-partition rows on (partition columns, order) before a ``partitionBy`` write.

    Each task then holds a contiguous key range, so it writes files for only a
    few partition values (few, large files), while a hot partition value is
    still cut over several tasks by ``order`` instead of landing in one.
    """
    return df.repartitionByRange(*partition_by, *order)  # no fixed number: AQE may coalesce ranges


def append_table(df: DataFrame, name: str, path: str | None = None) -> str:
    """Append to a named table (external at ``path`` when given)."""
    w = df.write.mode("append").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None,
                   sort: bool = True) -> str:
    """Write a table bucketed (and sorted) by ``key`` into ``buckets`` files per task group.

    Two tables bucketed the same way on their join key are joined later
    without shuffling either side (sort-merge join on co-located buckets), so
    a join that is run again and again over large tables pays the shuffle once.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name
