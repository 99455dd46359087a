"""Late ticks found by the stream itself, from the order in which ticks arrive.

Every micro-batch is compared with the watermark of the batches before it
(their latest event time less the allowed delay). All ticks land, those behind
the watermark marked ``late``; live bars are built from the others, and a
correction run rebuilds the days that late ticks touch.

A batch writes the folder of its own id and then its watermark, computed from
the batch before only. A batch that runs again (a restart between the write and
the commit) sees the same watermark and replaces its own rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickweave.operators.bars import bar_start
from tickweave.streaming.correction import bars_by_day, rebuilt_bars, touched_days, write_bars
from tickweave.streaming.landing import with_ingest_date

BATCH, LATE = "batch_id", "late"


def _mark(spark: SparkSession, root: str, batch_id: int) -> dt.datetime | None:
    """Latest event time of all batches up to ``batch_id`` (one row in that batch's folder)."""
    if batch_id < 0:
        return None
    return spark.read.schema("latest timestamp_ntz").parquet(f"{root}/marks/{BATCH}={batch_id}").first()["latest"]


def land_batch(batch: DataFrame, batch_id: int, root: str, delay: str, ts: str = "ts") -> None:
    """Land one micro-batch under ``root``: rows with ``late`` and ``ingest_date``, then the batch's watermark.

    A tick is late when its time is before the latest time of all earlier
    batches less ``delay``; one without a time is never late. Of a batch that
    lands twice the rows are the same and are there once.
    """
    spark = batch.sparkSession
    latest = _mark(spark, root, batch_id - 1)
    behind = F.lit(False) if latest is None else F.coalesce(
        F.col(ts) < F.lit(latest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}"), F.lit(False))
    seen = Observation(f"landed-{batch_id}")
    rows = with_ingest_date(batch.withColumn(LATE, behind), ts).withColumn(BATCH, F.lit(batch_id))
    (rows.observe(seen, F.max(ts).alias("latest")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH, LATE, "ingest_date").parquet(f"{root}/ticks"))
    _write_mark(spark, root, batch_id, max((t for t in (latest, seen.get["latest"]) if t is not None), default=None))


def _write_mark(spark: SparkSession, root: str, batch_id: int, latest: dt.datetime | None) -> None:
    spark.createDataFrame([(latest,)], "latest timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(
        f"{root}/marks/{BATCH}={batch_id}")


def land_marking_late(stream: DataFrame, root: str, checkpoint: str, delay: str = "5 minutes", ts: str = "ts",
                      processing_time: str | None = None) -> StreamingQuery:
    """Land a tick stream with :func:`land_batch`; with ``processing_time`` until stopped, else what is there."""
    w = stream.writeStream.foreachBatch(lambda df, i: land_batch(df, i, root, delay, ts)).option(
        "checkpointLocation", checkpoint)
    return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()


def landed_schema(ticks: DataFrame) -> str:
    """Schema of the landed table, given the stream or a table like it."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ticks.schema.fields]
    return ", ".join([*fields, f"{BATCH} long", f"{LATE} boolean", "ingest_date string"])


def landed(spark: SparkSession, root: str, schema: str, late: bool | None = None) -> DataFrame:
    """All landed ticks, or the late or on-time ones only (other folders are not read)."""
    rows = spark.read.schema(schema).parquet(f"{root}/ticks")
    return rows if late is None else rows.where(F.col(LATE) == late)


def on_time_stream(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The on-time ticks as a stream, for the live bars.

    Batches that ran again leave new files; the live bars drop their ticks as
    re-deliveries (``dedupe_on``) or as late.
    """
    return spark.readStream.schema(schema).parquet(f"{root}/ticks").where(~F.col(LATE))


def open_days(ticks: DataFrame, live: DataFrame, width: str, ts: str = "ts") -> DataFrame:
    """Start days of bars that on-time ticks fall in and the live bars do not have (not closed yet)."""
    start = bar_start(ts, width).alias("bar_start")
    return (ticks.where(F.col(ts).isNotNull()).select("instrument", start).distinct()
            .join(live.select("instrument", "bar_start"), ["instrument", "bar_start"], "left_anti")
            .select(F.to_date("bar_start").alias("day")).distinct())


def correct(spark: SparkSession, root: str, schema: str, live: DataFrame, corrected_path: str, width: str,
            ticks_view=lambda df: df, **kw) -> DataFrame:
    """Bars after a correction run: days with late ticks or bars still open are rebuilt from all landed ticks.

    The rebuilt days go to ``corrected_path`` (each replaced as a whole, so a
    run can be repeated); all other days stay the live bars'. The live table is
    not rewritten: its commit log stays valid.
    """
    all_ticks = landed(spark, root, schema)
    days = touched_days(landed(spark, root, schema, late=True), width).unionByName(
        open_days(ticks_view(landed(spark, root, schema, late=False)), live, width)).distinct()
    write_bars(rebuilt_bars(all_ticks, days, width, ticks_view, **kw), corrected_path)
    return current_bars(spark, live, corrected_path, bars_by_day(ticks_view(all_ticks), width, **kw))


def current_bars(spark: SparkSession, live: DataFrame, corrected_path: str, like: DataFrame) -> DataFrame:
    """Live bars of days never corrected, and the corrected bars; columns as in ``like``."""
    try:
        fixed = spark.read.schema(like.schema).parquet(corrected_path)
    except AnalysisException:  # no correction run yet
        return live.select(*like.columns)
    days = fixed.select("ingest_date").distinct()
    return live.join(days, "ingest_date", "left_anti").select(*like.columns).unionByName(fixed)
