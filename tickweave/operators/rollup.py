"""Bars of many widths from stored partial bars, and series without gaps.

A partial bar keeps, beside open and close, the order keys of the ticks they
came from. Partial bars merge: any number of rows of one bar, or of the bars of
a longer one, give the same bar as their ticks. They are written once at a
small width; every wider bar is a roll-up of them and reads no tick, and ticks
that come late are added as partial bars of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.ordering import order_key
from tickweave.functions.timeutil import day_tag
from tickweave.operators.bars import CALENDAR_UNITS, bar_start, ohlcv
from tickweave.sinks.files import cluster_for_partitioned_write

FIRST_KEY, LAST_KEY = "open_key", "close_key"
DAY_SECONDS = 86_400


def partial_bars(ticks: DataFrame, width: int = 60, keys=("instrument",), ts: str = "ts", seq: str | None = "seq",
                 **columns) -> DataFrame:
    """Bars of ``width`` seconds with the order keys of open and close (``open_key``, ``close_key``)."""
    order = order_key(ticks, ts, seq)
    return ohlcv(ticks, int(width), keys=keys, ts=ts, seq=seq, **columns,
                 extra_aggs={FIRST_KEY: F.min(order), LAST_KEY: F.max(order)})


def store(partials: DataFrame, path: str) -> str:
    """Append partial bars to a table partitioned by the day they start in (``ingest_date``)."""
    rows = partials.withColumn("ingest_date", day_tag("bar_start"))
    cluster_for_partitioned_write(rows, ["ingest_date"], ["bar_start"]).write.mode("append").partitionBy(
        "ingest_date").parquet(path)
    return path


def roll_up(partials: DataFrame, stored_width: int, width: int | None = None, calendar: str | None = None,
            keys=("instrument",)) -> DataFrame:
    """Bars of ``width`` seconds, or of a calendar unit, from partial bars of ``stored_width`` seconds.

    ``width`` must be a multiple of the stored width; for calendar units the
    stored width must divide a day. The result has the same columns, so it can
    be rolled up again. One row per map task and bar is exchanged.
    """
    if (width is None) == (calendar is None):
        raise ValueError("give a width or a calendar unit")
    if (width if width is not None else DAY_SECONDS) % stored_width:
        raise ValueError(f"bars of {stored_width} seconds do not make up {calendar or str(width) + ' seconds'}")
    start = bar_start("bar_start", None if calendar else f"{width} seconds", calendar)
    out = partials.groupBy(*keys, start.alias("__start")).agg(
        F.min_by("open", FIRST_KEY).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", LAST_KEY).alias("close"), F.sum("volume").alias("volume"), F.sum("ticks").alias("ticks"),
        F.min(FIRST_KEY).alias(FIRST_KEY), F.max(LAST_KEY).alias(LAST_KEY))
    length = F.expr(f"INTERVAL {CALENDAR_UNITS[calendar.lower()] if calendar else str(width) + ' seconds'}")
    return out.select(*keys, F.col("__start").alias("bar_start"),
                      (F.col("__start") + length).cast("timestamp_ntz").alias("bar_end"),
                      "open", "high", "low", "close", "volume", "ticks", FIRST_KEY, LAST_KEY)


def bars_only(rolled: DataFrame) -> DataFrame:
    return rolled.drop(FIRST_KEY, LAST_KEY)


def fill_missing(bars: DataFrame, width: int = 60, keys=("instrument",), whole_days: bool = True) -> DataFrame:
    """Bars without gaps: missing bars of each key carry the last close, without volume and ticks, marked ``filled``.

    bars -- one row per (keys, bar_start): ``bar_start, open, high, low, close, volume, ticks``; ``width``
            seconds, which must divide a day. Further columns are left out; bars without a time too.
    whole_days -- from a key's first bar to its last, over nights and days without bars; else only from the
            first bar of each day to its last, with the close of the day before carried in.

    A key is cut at day edges: one row per (key, day) carries the last close
    over, and every day's series is made and joined for itself, by (key, day).
    No task holds more of a key than a day, and nothing is cross-joined.
    """
    if DAY_SECONDS % width:
        raise ValueError("the width must divide a day")
    cols = ["open", "high", "low", "close", "volume", "ticks"]
    step = F.expr(f"INTERVAL {int(width)} seconds")
    rows = bars.where(F.col("bar_start").isNotNull()).select(*keys, "bar_start", *cols, F.to_date("bar_start").alias("__day"))
    known = F.when(F.col("close").isNotNull(), F.struct("bar_start", "close"))
    days = rows.groupBy(*keys, "__day").agg(F.min("bar_start").alias("__first"), F.max("bar_start").alias("__last"),
                                            F.max(known)["close"].alias("__close"))
    order = Window.partitionBy(*keys).orderBy("__day")  # one row per key and day
    days = days.select(*keys, "__day", "__first", "__last", "__close",
                       F.last("__close", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"),
                       F.lag("__day").over(order).alias("__before"), F.lead("__day").over(order).alias("__after"))
    if whole_days:
        until = F.coalesce(F.date_add("__after", -1), F.col("__day"))
        days = days.withColumn("__on", F.explode(F.sequence("__day", until)))
        own = F.col("__on") == F.col("__day")
        opens, closes = F.col("__on").cast("timestamp_ntz"), F.date_add("__on", 1).cast("timestamp_ntz") - step
        first = F.when(own & F.col("__before").isNull(), F.col("__first")).otherwise(opens)
        last = F.when(own & F.col("__after").isNull(), F.col("__last")).otherwise(closes)
        carry = F.when(own, F.col("__carry")).otherwise(F.coalesce("__close", "__carry"))
    else:
        days = days.withColumn("__on", F.col("__day"))
        first, last, carry = F.col("__first"), F.col("__last"), F.col("__carry")
    spine = days.select(*[F.col(k).alias(f"__{k}") for k in keys], "__on", carry.alias("__carry"),
                        F.explode(F.sequence(first, last, step)).alias("__start"))
    # The day is a join key of both sides, so a key is dealt by days.
    same = (F.col("__on") == F.col("__day")) & (F.col("__start") == F.col("bar_start"))
    for k in keys:
        same = same & F.col(f"__{k}").eqNullSafe(F.col(k))
    found = spine.join(rows, same, "left").select(
        *[F.col(f"__{k}").alias(k) for k in keys], "__on", "__carry", "__start", *cols, F.col("bar_start").isNull().alias("filled"))
    within = Window.partitionBy(*keys, "__on").orderBy("__start")
    before = F.coalesce(F.last("close", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.col("__carry"))
    value = {c: F.when(F.col("filled"), F.lit(0) if c in ("volume", "ticks") else F.col("__before")).otherwise(F.col(c))
             .cast(bars.schema[c].dataType).alias(c) for c in cols}
    return found.withColumn("__before", before).select(
        *keys, F.col("__start").alias("bar_start"), (F.col("__start") + step).alias("bar_end"), *value.values(), "filled")
