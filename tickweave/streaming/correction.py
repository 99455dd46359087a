"""Correction run for late ticks.

Ticks that arrive after the watermark are dropped by the live bars query. The
landed table still receives them (landing has no watermark), so a batch run
re-derives bars from the landed ticks. Bar tables are partitioned by the day a
bar starts in. The days replaced are the *start days of the bars* the late ticks
fall in; to rebuild every bar that starts on such a day, the run reads each day
those bars span (a bar over midnight, a week or a month spans several). Only
the replaced days are overwritten (dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.timeutil import day_tag
from tickweave.operators.bars import CALENDAR_UNITS, bar_start, ohlcv
from tickweave.sinks.files import cluster_for_partitioned_write


def bars_by_day(ticks: DataFrame, width: str | None, **kw) -> DataFrame:
    """Bars with an ``ingest_date`` partition column taken from the bar start."""
    return ohlcv(ticks, width, **kw).withColumn("ingest_date", day_tag("bar_start"))


def write_bars(bars: DataFrame, path: str, dynamic: bool = True) -> None:
    """Write day-partitioned bars; with ``dynamic`` only the days present are replaced."""
    bars = cluster_for_partitioned_write(bars, ["ingest_date"], ["bar_start"])
    w = bars.write.mode("overwrite").partitionBy("ingest_date")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def touched_days(late_ticks: DataFrame, width: str | None = None, calendar: str | None = None,
                 ts: str = "ts") -> DataFrame:
    """Start days of the bars that late ticks fall in (one row per day: bounded by the calendar)."""
    return (late_ticks.where(F.col(ts).isNotNull())
            .select(F.to_date(bar_start(ts, width, calendar)).alias("day")).distinct())


def _spanned_days(days: DataFrame, width: str | None, calendar: str | None) -> DataFrame:
    """Day tags of all days that bars starting on ``days`` span."""
    length = F.expr(f"INTERVAL {CALENDAR_UNITS[calendar.lower()] if calendar else width}")
    # The last bar that starts on a day starts before the next day.
    until = F.to_date(F.date_add("day", 1).cast("timestamp_ntz") + length)
    return days.select(F.explode(F.sequence(F.col("day"), until)).alias("day")).distinct().select(
        day_tag("day").alias("ingest_date"))


def rebuilt_bars(landed: DataFrame, days: DataFrame, width: str | None = None, ticks_view=lambda df: df,
                 calendar: str | None = None, **kw) -> DataFrame:
    """All bars that start on ``days``, from the landed ticks (a table partitioned by ``ingest_date``).

    The landed scan is semi-joined with the days those bars span on its
    partition column, so other days are not read.
    """
    affected = landed.join(_spanned_days(days, width, calendar), "ingest_date", "left_semi")
    bars = bars_by_day(ticks_view(affected), width, calendar=calendar, **kw)
    return bars.join(days.select(day_tag("day").alias("ingest_date")), "ingest_date", "left_semi")


def correct_bars(spark: SparkSession, landed_path: str, bars_path: str, days: DataFrame,
                 width: str | None = None, ticks_view=lambda df: df, calendar: str | None = None, **kw) -> None:
    """Rebuild all bars that start on ``days`` (see :func:`touched_days`) and replace those day partitions."""
    bars = rebuilt_bars(spark.read.parquet(landed_path), days, width, ticks_view, calendar, **kw)
    write_bars(bars, bars_path, dynamic=True)
