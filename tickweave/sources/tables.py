"""Driver test tables and the tick / order views built over them.

The views only rename and derive columns, so Catalyst prunes the Parquet scan
to the columns a query touches and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table: one plan at every size.

    Spark cuts the scan by ``spark.sql.files.maxPartitionBytes`` and row group.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_ticks(events: DataFrame) -> DataFrame:
    """Tick view on ``events``: one instrument per event type.

    instrument = event_type, ts = ts, price = value, qty = props.k, seq = event_id.
    """
    return events.select(
        F.col("event_type").alias("instrument"),
        F.col("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("int").alias("qty"),
        F.col("event_id").alias("seq"),
    )


def lineitem_ticks(lineitem: DataFrame, *keep: str) -> DataFrame:
    """Tick view on ``lineitem``: instrument = part, daily time, price = extended price.

    (l_orderkey, l_linenumber) is not unique, so the tie-break order carries
    (l_orderkey, l_linenumber, l_suppkey) and the price itself. ``keep``: further columns.
    """
    return lineitem.select(
        F.col("l_partkey").alias("instrument"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("qty"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("seq"), *keep,
    )


# Order states in the life of an order, and the event type that
# stands for each state in the events test table.
ORDER_STATES = {
    "view": "PendingNew",
    "click": "New",
    "signup": "PartiallyFilled",
    "purchase": "Filled",
    "error": "Rejected",
}


def event_orders(events: DataFrame, client_id: str | None = None) -> DataFrame:
    """Order-state view on ``events``: each user is one order, each event a state change.

    clientID groups ten users; state follows the event type; (ts, seq) orders changes.
    ``client_id``: one client only, as a range of users, which the scan filters on.
    """
    if client_id is not None:
        first = int(client_id.removeprefix("CL")) * 10
        events = events.where(F.col("user_id").between(first, first + 9))
    state = F.lit(None).cast("string")
    for et, st in ORDER_STATES.items():
        state = F.when(F.col("event_type") == et, F.lit(st)).otherwise(state)
    return events.select(
        F.format_string("CL%04d", F.expr("user_id div 10")).alias("clientID"),
        F.col("user_id").alias("appOrderID"),
        state.alias("state"),
        F.get_json_object("props", "$.k").try_cast("long").alias("filled_quantity"),
        F.col("value").alias("filled_price"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )


def trade_fills(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Trades on ``lineitem`` x ``orders``: client = customer, instrument = part.

    ``l_returnflag = 'R'`` is a sell, anything else a buy; order status F is a
    fill, P a part fill, O open (no trade).
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
                         "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    od = orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("clientID"),
        F.col("l_orderkey").alias("appOrderID"),
        F.col("l_linenumber").alias("fill_no"),
        F.col("l_suppkey").alias("counterparty"),
        F.col("l_partkey").alias("instrument"),
        F.when(F.col("l_returnflag") == "R", F.lit("SELL")).otherwise(F.lit("BUY")).alias("side"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("l_shipdate").alias("trade_ts"),
    )
