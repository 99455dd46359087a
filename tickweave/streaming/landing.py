"""Landing: decoded ticks -> Parquet partitioned by the tick's own day.

One checkpoint per query (not per day): restarts resume from the committed
offsets, and the file sink's commit log makes the output exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickweave.functions.timeutil import day_tag
from tickweave.operators.decode import CORRUPT, REASON, STATUS, with_status


def with_ingest_date(df: DataFrame, ts) -> DataFrame:
    """Partition column ``ingest_date`` (``yyyy_MM_dd``) from each row's event time."""
    return df.withColumn("ingest_date", day_tag(F.col(ts) if isinstance(ts, str) else ts))


def observed(stream: DataFrame, name: str = "landing") -> DataFrame:
    """Attach per-batch metrics (rows, corrupt rows, quarantined rows) to the stream.

    They appear in each micro-batch's progress under ``observedMetrics`` (the
    delivery report of the bus producer, computed on executors).
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if CORRUPT in stream.columns:
        metrics.append(F.count(F.col(CORRUPT)).alias("corrupt"))
    if REASON in stream.columns:
        metrics.append(F.count(F.col(REASON)).alias("quarantined"))
    return stream.observe(name, *metrics)


def land(stream: DataFrame, path: str, checkpoint: str, partition_by=("ingest_date",),
         available_now: bool = False, processing_time: str | None = None,
         query_name: str | None = None, files_per_partition: int | None = None) -> StreamingQuery:
    """Append the stream to Parquet at ``path`` (one folder per partition value).

    ``files_per_partition``: deal rows by partition value and a hash over so many tasks, so that a
    micro-batch writes at most that many files per folder (not one per task and folder).
    """
    if partition_by and files_per_partition:
        rest = [c for c in stream.columns if c not in partition_by]
        stream = stream.repartition(*partition_by, F.pmod(F.xxhash64(*rest), F.lit(files_per_partition)))
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def land_checked(checked: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Clean and quarantined rows (with reason and raw text) in one table, partitioned by (status, ingest_date).

    One streaming query and one commit log: readers see whole batches, and a
    filter on ``status`` or ``ingest_date`` prunes folders.
    """
    return land(with_status(checked), path, checkpoint, partition_by=(STATUS, "ingest_date"), **options)


def progress_summary(query: StreamingQuery) -> list[dict]:
    """Per micro-batch delivery report: batch id, input rows, late rows dropped, observed metrics."""
    out = []
    for p in query.recentProgress:
        dropped = sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))
        out.append({"batchId": p.get("batchId"), "numInputRows": p.get("numInputRows"),
                    "droppedByWatermark": dropped,
                    "observed": {k: (v.asDict() if hasattr(v, "asDict") else dict(v))
                                 for k, v in (p.get("observedMetrics") or {}).items()}})
    return out
