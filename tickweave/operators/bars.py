"""Open/high/low/close/volume bars.

One function serves batch and Structured Streaming: it only declares a
grouping, so Spark plans one partial aggregate per map task, one shuffle on
(keys, bar) and a final aggregate. Open and close are taken with
``min_by`` / ``max_by`` over the (time, sequence) order, so they do not depend
on the order rows arrive in after the shuffle.

Skew: the group key includes the bar, so even an instrument that holds a third
of all ticks spreads over all its bars, and the partial aggregate collapses
each map task's rows of one bar to one row before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.ordering import order_key
from tickweave.functions.timeutil import clock_label, parse_request_time

CALENDAR_UNITS = {"day": "1 day", "week": "1 week", "month": "1 month",
                  "quarter": "3 months", "year": "1 year"}


def bar_start(ts: str, width: str | None = None, calendar: str | None = None) -> Column:
    """Start of the bar a time falls in (batch): an epoch-aligned width, or a calendar unit."""
    if calendar:
        return F.date_trunc(calendar.lower(), F.col(ts)).cast("timestamp_ntz")
    return F.window(F.col(ts), width).start


def ohlcv(ticks: DataFrame, width: str | int | None = "1 minute", keys=("instrument",),
          ts: str = "ts", price: str = "price", qty: str = "qty", seq: str | None = "seq",
          calendar: str | None = None, label: str | None = None,
          label_side: str = "end", extra_aggs: dict | None = None,
          label_zone: str | None = None) -> DataFrame:
    """Bars per ``keys`` and time bucket.

    width     -- bar width as an interval string or seconds (tumbling window, epoch aligned)
    calendar  -- instead of width: 'day' | 'week' | 'month' | 'quarter' | 'year' (batch only)
    label     -- optional text label of the bar edge given by ``label_side`` (e.g. 'HH:mm'),
                 shown in ``label_zone`` when given (grouping stays UTC)
    extra_aggs -- {name: aggregate column} computed in the same pass
    Output: keys, bar_start, bar_end, open, high, low, close, volume, ticks[, extras].
    """
    if isinstance(width, int):
        width = f"{width} seconds"
    order = order_key(ticks, ts, seq)
    aggs = [
        F.min_by(F.col(price), order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(F.col(price), order).alias("close"),
        F.sum(qty).alias("volume"),
        F.count(F.lit(1)).alias("ticks"),
        *[agg.alias(name) for name, agg in (extra_aggs or {}).items()],
    ]
    extra = list(extra_aggs or {})
    if calendar:
        unit = calendar.lower()
        start = bar_start(ts, calendar=unit)
        grouped = ticks.where(F.col(ts).isNotNull()).groupBy(*keys, start.alias("bar_start")).agg(*aggs)
        out = grouped.withColumn(
            "bar_end", (F.col("bar_start") + F.expr(f"INTERVAL {CALENDAR_UNITS[unit]}")).cast("timestamp_ntz"))
    elif ticks.isStreaming:
        # A stream must group on the window struct: the watermark is tracked on it.
        grouped = ticks.groupBy(*keys, F.window(F.col(ts), width).alias("bar")).agg(*aggs)
        out = grouped.select(*keys, F.col("bar.start").alias("bar_start"),
                             F.col("bar.end").alias("bar_end"),
                             "open", "high", "low", "close", "volume", "ticks", *extra)
    else:
        # Batch groups on a plain bar_start column, so the result is hash
        # partitioned on (keys, bar_start): a later join or aggregate on the
        # same keys reuses that partitioning instead of shuffling again.
        start = bar_start(ts, width)
        grouped = (ticks.where(F.col(ts).isNotNull())
                   .groupBy(*keys, start.alias("bar_start")).agg(*aggs))
        out = grouped.withColumn("bar_end", (F.col("bar_start") + F.expr(f"INTERVAL {width}")))
    cols = [*keys, "bar_start", "bar_end", "open", "high", "low", "close", "volume", "ticks", *extra]
    out = out.select(*cols)
    if label:
        out = out.withColumn("bar_label", clock_label(F.col("bar_" + label_side), label, label_zone))
    return out


def restrict_time(ticks: DataFrame, start_text: str, end_text: str, ts: str = "ts") -> DataFrame:
    """Keep ticks with start <= ts <= end; bounds given as ``'MMM d yyyy HHmmss'`` text.

    The bounds fold to literals, so the predicate is pushed into the Parquet scan.
    """
    lo = parse_request_time(F.lit(start_text))
    hi = parse_request_time(F.lit(end_text))
    return ticks.where(F.col(ts).between(lo, hi))


def history_bars(ticks: DataFrame, start_text: str, end_text: str, compression_seconds: int,
                 keys=("instrument",), **kw) -> DataFrame:
    """Bars at a requested width (seconds) inside a requested time range."""
    return ohlcv(restrict_time(ticks, start_text, end_text), f"{int(compression_seconds)} seconds",
                 keys=keys, **kw)


def stack_bars(*frames: DataFrame) -> DataFrame:
    """Stack per-instrument bar tables (or appended rows) by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
