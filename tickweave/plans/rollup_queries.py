"""Bars of several widths from stored partial bars, and bar series without gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.operators import rollup
from tickweave.plans.bar_queries import _event_bar_sql, event_bars
from tickweave.plans.catalog import register
from tickweave.session import work_path
from tickweave.sources.tables import event_ticks, table

_WIDTHS = {"5 minutes": 300, "1 hour": 3600, "1 day": 86_400}


@register("bars_rolled_up", sql="\nUNION ALL\n".join(
    f"SELECT '{name}' AS width, * FROM ({_event_bar_sql(seconds)})" for name, seconds in _WIDTHS.items()),
    ids=("A1", "A10"))
def q_bars_rolled_up(spark, sf_dir):
    """Five-minute, hourly and daily bars rolled up from stored one-minute partial bars; no tick is read again.

    The ticks are stored in two appends (even and odd ids), so bars merge across them.
    """
    path = work_path(spark, "partial-bars")
    ticks = event_ticks(table(spark, sf_dir, "events"))
    for part in (F.col("seq") % 2 == 0, F.col("seq") % 2 != 0):
        partials = rollup.partial_bars(ticks.where(part), 60)
        rollup.store(partials, path)
    stored = spark.read.schema(partials.schema).parquet(path)
    out = [rollup.bars_only(rollup.roll_up(stored, 60, s)).select(F.lit(name).alias("width"), "*") for name, s in _WIDTHS.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("bars_rolled_up_monthly", sql=f"""
SELECT instrument, date_trunc('month', bar_start)::TIMESTAMP AS bar_start,
       (date_trunc('month', bar_start) + INTERVAL 1 MONTH)::TIMESTAMP AS bar_end, first(open ORDER BY bar_start) AS open,
       max(high) AS high, min(low) AS low, last(close ORDER BY bar_start) AS close, CAST(sum(volume) AS BIGINT) AS volume,
       CAST(sum(ticks) AS BIGINT) AS ticks
FROM ({_event_bar_sql(86_400)}) GROUP BY 1, 2, 3
""", ids=("A1", "A10"))
def q_bars_rolled_up_monthly(spark, sf_dir):
    """Calendar-month bars rolled up from hourly ones, themselves rolled up from one-minute partial bars."""
    minutes = rollup.partial_bars(event_ticks(table(spark, sf_dir, "events")), 60)
    path = rollup.store(minutes, work_path(spark, "partial-bars"))
    hours = rollup.roll_up(spark.read.schema(minutes.schema).parquet(path), 60, 3600)
    return rollup.bars_only(rollup.roll_up(hours, 3600, calendar="month"))


def _filled_sql(seconds: int, whole_days: bool) -> str:
    spine = f"SELECT instrument, unnest(generate_series(min(bar_start), max(bar_start), INTERVAL {seconds} SECOND)) AS bar_start FROM b"
    spine += " GROUP BY instrument" if whole_days else " GROUP BY instrument, CAST(bar_start AS DATE)"
    price = "coalesce({c}, last_value(b.close IGNORE NULLS) OVER w) AS {c}"
    return f"""
WITH b AS ({_event_bar_sql(seconds)}), s AS ({spine})
SELECT s.instrument, s.bar_start, s.bar_start + INTERVAL {seconds} SECOND AS bar_end,
       {", ".join(price.format(c=c) for c in ("open", "high", "low", "close"))},
       CASE WHEN b.instrument IS NULL THEN 0 ELSE volume END AS volume, coalesce(ticks, 0) AS ticks, b.instrument IS NULL AS filled
FROM s LEFT JOIN b ON b.instrument = s.instrument AND b.bar_start = s.bar_start
WINDOW w AS (PARTITION BY s.instrument ORDER BY s.bar_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


@register("bars_filled", sql=_filled_sql(60, True), ids=("A1", "X12"))
def q_bars_filled(spark, sf_dir):
    """One-minute bars without gaps from each instrument's first to its last, missing ones with the last close."""
    return rollup.fill_missing(event_bars(spark, sf_dir, "1 minute"), 60)


@register("bars_filled_in_session", sql=_filled_sql(300, False), ids=("A10", "X12"))
def q_bars_filled_in_session(spark, sf_dir):
    """Five-minute bars without gaps between the first and last bar of each day, closes carried over nights."""
    return rollup.fill_missing(event_bars(spark, sf_dir, "5 minutes"), 300, whole_days=False)
