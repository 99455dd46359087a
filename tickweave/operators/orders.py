"""Order books, order history, trade books and positions.

Latest-state look-ups are ``max_by`` aggregates (partial aggregation per task,
so a hot order or client costs one row per task in the shuffle); the history
uses the skew-safe sequence operator; positions are grouped sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.ordering import fixed_width, order_key, packable
from tickweave.operators.sequence import sequence_steps

ORDER_KEY = ("ts", "seq")
FILLED = ("F", "P")
MONEY = "decimal(18,4)"


def _client(df: DataFrame, client_id) -> DataFrame:
    return df if client_id is None else df.where(F.col("clientID") == client_id)


def latest_per_key(df: DataFrame, keys, order=ORDER_KEY, cols=None) -> DataFrame:
    """The latest row per key by ``order`` (ties broken by the full order).

    With a (timestamp, integer) order and fixed-width values, each value is a
    ``max_by`` on the packed decimal order key: all buffers are fixed width and
    Spark hash-aggregates. Otherwise one ``max_by`` over a struct of the values.
    """
    cols = [c for c in (cols or df.columns) if c not in keys]
    if len(order) == 2 and packable(df, *order) and fixed_width(df, cols):
        okey = order_key(df, *order)
        return df.groupBy(*keys).agg(*[F.max_by(F.col(c), okey).alias(c) for c in cols],
                                     F.count(F.lit(1)).alias("updates"))
    okey = F.struct(*[F.col(c) for c in order])  # a NULL part is the lowest, as in the packed key
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), okey).alias("__r"),
                 F.count(F.lit(1)).alias("updates"))
            .select(*keys, "__r.*", "updates"))


def order_book(order_events: DataFrame, client_id=None) -> DataFrame:
    """Current state of each order (one client, or all clients when None: the dealer book)."""
    return latest_per_key(_client(order_events, client_id), ["appOrderID"])


def order_history(order_events: DataFrame, order_id=None, bucket: str = "hour") -> DataFrame:
    """State chain of each order: state, previous state and step, in (ts, seq) order.

    ``bucket``: unit of time within which one task numbers an order's changes (see :func:`sequence_steps`).
    """
    ev = order_events if order_id is None else order_events.where(F.col("appOrderID") == order_id)
    ev = ev.select("clientID", "appOrderID", "ts", "seq", "state")
    return sequence_steps(ev, "appOrderID", list(ORDER_KEY), "state", bucket=bucket)


def quote_snapshot(ticks: DataFrame, keys=("instrument",), subscriptions: DataFrame | None = None) -> DataFrame:
    """Latest tick per instrument, optionally only for listed instruments (a
    semi-join with the request list, of any size, before the aggregate)."""
    if subscriptions is not None:
        ticks = ticks.join(subscriptions, list(keys), "left_semi")
    return latest_per_key(ticks, list(keys))


def trade_book(fills: DataFrame, client_id=None, day=None) -> DataFrame:
    """Fills and part fills (one client or all; one day or all)."""
    t = _client(fills, client_id).where(F.col("status").isin(*FILLED))
    t = t.withColumn("trade_day", F.to_date("trade_ts"))
    return t if day is None else t.where(F.col("trade_day") == F.lit(day).cast("date"))


def _money(c):
    # Sum money exactly in decimal (currency segments trade in four decimals), report as double.
    return F.col(c).cast(MONEY)


def positions(fills: DataFrame, by=("clientID", "instrument"), day_wise: bool = False,
              client_id=None) -> DataFrame:
    """Bought / sold / net quantity and value per ``by`` (plus trade day when day-wise)."""
    t = trade_book(fills, client_id)
    keys = [*by, "trade_day"] if day_wise else list(by)
    buy, sell = F.col("side") == "BUY", F.col("side") == "SELL"
    out = t.groupBy(*keys).agg(
        F.sum(F.when(buy, F.col("qty")).otherwise(0.0)).alias("bought_qty"),
        F.sum(F.when(sell, F.col("qty")).otherwise(0.0)).alias("sold_qty"),
        F.sum(F.when(buy, _money("amount")).otherwise(F.lit(0).cast(MONEY))).alias("__bv"),
        F.sum(F.when(sell, _money("amount")).otherwise(F.lit(0).cast(MONEY))).alias("__sv"),
        F.count(F.lit(1)).alias("trades"))
    return out.select(*keys, "bought_qty", "sold_qty",
                      (F.col("bought_qty") - F.col("sold_qty")).alias("net_qty"),
                      F.col("__bv").cast("double").alias("bought_value"),
                      F.col("__sv").cast("double").alias("sold_value"),
                      (F.col("__sv") - F.col("__bv")).cast("double").alias("net_value"), "trades")


def holdings(fills: DataFrame, before_day: str, client_id=None) -> DataFrame:
    """Long-term holdings: net position of trades before ``before_day``, positive net only."""
    t = fills.where(F.to_date("trade_ts") < F.lit(before_day).cast("date"))
    return positions(t, client_id=client_id).where(F.col("net_qty") > 0)
