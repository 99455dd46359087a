"""Subscriptions over time: which ticks came while their instrument was subscribed.

Subscribe and unsubscribe events become intervals; ticks meet the intervals by
an equi-join on (instrument, time bucket) with the exact bounds checked beside
it. An interval is repeated once per bucket it touches, so the join never
compares all intervals of an instrument with all its ticks, and an instrument
that holds most of the ticks is dealt by bucket.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("segment", "instrument")


def intervals(events: DataFrame, on: Column, keys=KEYS, ts: str = "ts", seq: str = "seq", bucket: str = "day") -> DataFrame:
    """``keys, from_ts, until_ts``: the times during which each key is subscribed.

    Each event holds from its time until the next event of its key (by ``ts``,
    then ``seq``); those where ``on`` is true give an interval, half open,
    without an end for the last one. Repeated subscribes give intervals that
    follow each other. Events without a time are left out; keys may be NULL.
    Numbered within (key, time bucket), so no key's events meet in one task.
    """
    rows = events.where(F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("from_ts"), F.col(seq).alias("__seq"), F.coalesce(on, F.lit(False)).alias("__on"),
        F.date_trunc(bucket, ts).alias("__bucket"))
    local = Window.partitionBy(*keys, "__bucket").orderBy("from_ts", "__seq")
    rows = rows.withColumn("__next", F.lead("from_ts").over(local))
    firsts = rows.groupBy(*keys, "__bucket").agg(F.min("from_ts").alias("__first"))
    firsts = firsts.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__bucket").alias("__b"), F.lead("__first").over(
        Window.partitionBy(*keys).orderBy("__bucket")).alias("__later"))
    same = F.col("__bucket") == F.col("__b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return (rows.where("__on").join(firsts, same, "left")
            .select(*keys, "from_ts", F.coalesce("__next", "__later").alias("until_ts"))
            .where(F.col("until_ts").isNull() | (F.col("from_ts") < F.col("until_ts"))))


def _meet(ticks: DataFrame, held: DataFrame, how: str, keys, ts: str, bucket: str, horizon: dt.datetime | None) -> DataFrame:
    if horizon is None:
        horizon = ticks.agg(F.max(ts)).first()[0]  # one value: where intervals without an end are cut
    end = F.least(F.coalesce("until_ts", F.lit(horizon)), F.lit(horizon)).cast("timestamp_ntz")
    step = F.expr(f"INTERVAL 1 {bucket}")
    first = F.date_trunc(bucket, "from_ts").cast("timestamp_ntz")
    spread = held.where(F.col("from_ts") <= F.lit(horizon)).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("from_ts").alias("__from"), F.col("until_ts").alias("__until"),
        F.explode(F.sequence(first, F.date_trunc(bucket, end).cast("timestamp_ntz"), step)).alias("__bucket"))
    match = ((F.date_trunc(bucket, F.col(ts)).cast("timestamp_ntz") == F.col("__bucket")) & (F.col(ts) >= F.col("__from"))
             & (F.col("__until").isNull() | (F.col(ts) < F.col("__until"))))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return ticks.join(spread, match, how)


def during(ticks: DataFrame, held: DataFrame, keys=KEYS, ts: str = "ts", bucket: str = "day",
           horizon: dt.datetime | None = None) -> DataFrame:
    """The ticks that came within an interval of their key, each once.

    ``bucket``: unit of the time buckets; a finer one spreads a hot instrument
    over more tasks and repeats long intervals more often. ``horizon``: latest
    time of ``ticks`` (default: looked up). A tick without a time is in none.
    """
    return _meet(ticks, held, "left_semi", keys, ts, bucket, horizon)


def outside(ticks: DataFrame, held: DataFrame, keys=KEYS, ts: str = "ts", bucket: str = "day",
            horizon: dt.datetime | None = None) -> DataFrame:
    """The ticks that came outside all intervals of their key (those without a time too)."""
    return _meet(ticks, held, "left_anti", keys, ts, bucket, horizon)
