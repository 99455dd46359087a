"""Live bars from a tick stream: watermark + the batch bar operator, append mode.

A bar is emitted once the watermark (max event time seen - delay) passes its
end; ticks later than that are dropped by the state store and counted in the
query progress (``numRowsDroppedByWatermark``). A correction run over the
landed table (the batch operator) re-derives the affected bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.operators.bars import ohlcv


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): cast, the session zone being UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def live_bars(ticks: DataFrame, width: str = "1 minute", delay: str = "5 minutes", keys=("instrument",),
              dedupe_on=None, **kw) -> DataFrame:
    """Streaming OHLCV bars; ``dedupe_on`` drops re-delivered ticks within the watermark."""
    t = event_time(ticks).withWatermark("ts", delay)
    if dedupe_on:
        t = t.dropDuplicatesWithinWatermark(list(dedupe_on))
    bars = ohlcv(t, width, keys=keys, **kw)
    return (bars.withColumn("bar_start", F.col("bar_start").cast("timestamp_ntz"))
            .withColumn("bar_end", F.col("bar_end").cast("timestamp_ntz")))
