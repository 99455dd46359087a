"""Bar queries: OHLCV bars on the events and lineitem tick views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.operators.bars import history_bars, ohlcv, stack_bars
from tickweave.operators.reconcile import non_null_counts
from tickweave.plans.catalog import SQL_EVENT_QTY, register, sql_bucket, sql_bucket_end
from tickweave.sources.tables import event_ticks, lineitem_ticks, table

HOUR = 3600


def _event_bar_sql(seconds: int, where: str = "", label: bool = False) -> str:
    lab = f", strftime({sql_bucket_end('ts', seconds)}, '%H:%M') AS bar_label" if label else ""
    return f"""
SELECT event_type AS instrument,
       {sql_bucket('ts', seconds)} AS bar_start,
       {sql_bucket_end('ts', seconds)} AS bar_end,
       first(value ORDER BY ts, event_id) AS open,
       max(value) AS high,
       min(value) AS low,
       last(value ORDER BY ts, event_id) AS close,
       CAST(sum({SQL_EVENT_QTY}) AS BIGINT) AS volume,
       count(*) AS ticks{lab}
FROM events
WHERE ts IS NOT NULL {where}
GROUP BY 1, 2, 3
"""


def event_bars(spark, sf_dir, width="1 hour"):
    return ohlcv(event_ticks(table(spark, sf_dir, "events")), width)


@register("ohlcv_bars", sql=_event_bar_sql(HOUR), ids=("S3", "A1", "A2", "A3", "A4", "A5", "A6", "A7", "P5", "P13"))
def q_ohlcv_bars(spark, sf_dir):
    """Flagship: one-hour OHLCV bars per instrument on the events tick view."""
    return event_bars(spark, sf_dir, "1 hour")


@register("ohlcv_bars_minute", sql=_event_bar_sql(60, label=True), ids=("T2", "T3", "T4", "A1", "X1", "X2", "X3", "X4", "X5"))
def q_ohlcv_bars_minute(spark, sf_dir):
    """One-minute bars with the legacy ``HH:mm`` bar-end label kept beside full times."""
    return ohlcv(event_ticks(table(spark, sf_dir, "events")), "1 minute", label="HH:mm", label_side="end")


_LINE_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice"


def _line_bar_sql(start: str, end: str) -> str:
    return f"""
SELECT l_partkey AS instrument,
       {start} AS bar_start,
       {end} AS bar_end,
       first(l_extendedprice ORDER BY {_LINE_ORDER}) AS open,
       max(l_extendedprice) AS high,
       min(l_extendedprice) AS low,
       last(l_extendedprice ORDER BY {_LINE_ORDER}) AS close,
       sum(l_quantity) AS volume,
       count(*) AS ticks
FROM lineitem
WHERE l_shipdate IS NOT NULL
GROUP BY 1, 2, 3
"""


@register("ohlcv_bars_daily",
          sql=_line_bar_sql(sql_bucket("l_shipdate", 86400), sql_bucket_end("l_shipdate", 86400)),
          ids=("A1", "A7"))
def q_ohlcv_bars_daily(spark, sf_dir):
    """Daily bars per part on the lineitem tick view."""
    return ohlcv(lineitem_ticks(table(spark, sf_dir, "lineitem")), "1 day")


@register("ohlcv_bars_monthly",
          sql=_line_bar_sql("CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)",
                            "CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS TIMESTAMP)"),
          ids=("A1",))
def q_ohlcv_bars_monthly(spark, sf_dir):
    """Calendar-month bars per part (calendar buckets, not fixed widths)."""
    return ohlcv(lineitem_ticks(table(spark, sf_dir, "lineitem")), calendar="month")


HIST_START, HIST_END, HIST_WIDTH = "Jan 3 2024 091500", "Jan 17 2024 153000", 900


@register("history_bars",
          sql=_event_bar_sql(HIST_WIDTH, where="AND ts BETWEEN TIMESTAMP '2024-01-03 09:15:00' "
                                                "AND TIMESTAMP '2024-01-17 15:30:00'"),
          ids=("F6", "T8", "A10"))
def q_history_bars(spark, sf_dir):
    """Bars at a requested width in seconds within text bounds ``'MMM d yyyy HHmmss'``."""
    return history_bars(event_ticks(table(spark, sf_dir, "events")), HIST_START, HIST_END, HIST_WIDTH)


@register("stack_instruments", sql=f"""
SELECT 'events' AS source, instrument, bar_start, bar_end, open, high, low, close,
       CAST(volume AS DOUBLE) AS volume, ticks
FROM ({_event_bar_sql(HOUR)})
UNION ALL
SELECT 'lineitem' AS source, CAST(instrument AS VARCHAR), bar_start, bar_end, open, high, low, close,
       volume, ticks
FROM ({_line_bar_sql("CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)",
                     "CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS TIMESTAMP)")})
""", ids=("U1", "U2"))
def q_stack_instruments(spark, sf_dir):
    """Bar tables of two feeds stacked into one table with a source column."""
    a = event_bars(spark, sf_dir).withColumn("source", F.lit("events"))
    b = (ohlcv(lineitem_ticks(table(spark, sf_dir, "lineitem")), calendar="month")
         .withColumn("instrument", F.col("instrument").cast("string"))
         .withColumn("source", F.lit("lineitem")))
    cols = ["source", "instrument", "bar_start", "bar_end", "open", "high", "low", "close", "volume", "ticks"]
    a = a.withColumn("volume", F.col("volume").cast("double")).select(*cols)
    return stack_bars(a, b.select(*cols))


@register("sorted_head", sql=f"""
SELECT * FROM ({_event_bar_sql(HOUR)}) ORDER BY bar_start, instrument LIMIT 5
""", ids=("O1", "O2", "O3"))
def q_sorted_head(spark, sf_dir):
    """First five bars in time order (a top-k report: the limit is the feature)."""
    return event_bars(spark, sf_dir).orderBy("bar_start", "instrument").limit(5)


@register("sorted_head_20", sql=f"""
SELECT * FROM ({_event_bar_sql(HOUR)}) ORDER BY bar_start, instrument LIMIT 20
""", ids=("O1", "O3"))
def q_sorted_head_20(spark, sf_dir):
    """First twenty bars in time order (a top-k report: the limit is the feature)."""
    return event_bars(spark, sf_dir).orderBy("bar_start", "instrument").limit(20)


@register("bar_non_null_counts", sql=f"""
SELECT {", ".join(f"count({c}) AS {c}" for c in
                  ("instrument", "bar_start", "bar_end", "open", "high", "low", "close", "volume", "ticks"))}
FROM ({_event_bar_sql(HOUR)})
""", ids=("A8",))
def q_bar_non_null_counts(spark, sf_dir):
    """One row with the non-NULL count of every bar column."""
    return non_null_counts(event_bars(spark, sf_dir))


@register("sql_adhoc", sql=f"""
SELECT instrument, count(*) AS bars, CAST(sum(volume) AS BIGINT) AS volume,
       max(high) AS high, min(low) AS low,
       CAST(sum(CAST(close - open AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_move
FROM ({_event_bar_sql(HOUR)})
GROUP BY instrument
""", ids=("D3",))
def q_sql_adhoc(spark, sf_dir):
    """Ad-hoc SQL over the bars (named in the text, no view is left behind)."""
    return spark.sql("""
        SELECT instrument, count(*) AS bars, CAST(sum(volume) AS BIGINT) AS volume,
               max(high) AS high, min(low) AS low,
               CAST(sum(CAST(close - open AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_move
        FROM {bars} GROUP BY instrument""", bars=event_bars(spark, sf_dir))
