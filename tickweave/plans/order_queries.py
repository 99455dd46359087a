"""Routing, subscriptions, quotes, order / trade books, positions and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.operators import orders as O
from tickweave.operators import quality as Q
from tickweave.operators.bars import ohlcv
from tickweave.operators.decode import bytes_to_text, decode
from tickweave.operators.routing import request_table, route, route_all, subscribe, unsubscribe
from tickweave.plans.bar_queries import _event_bar_sql
from tickweave.plans.catalog import SQL_EVENT_QTY, register
from tickweave.plans.decode_queries import q_tick_quarantine
from tickweave.schemas import TICK_FEED1
from tickweave.sinks.bus import kafka_records
from tickweave.sources.messages import feed1_messages
from tickweave.sources.tables import ORDER_STATES, event_orders, event_ticks, table, trade_fills

# Message kind that each event type stands for in the test table.
EVENT_KINDS = {"click": 1501, "view": 1502, "signup": 1505, "error": 1507, "purchase": 1512}


def _kind_col():
    c = F.lit(None).cast("int")
    for et, code in EVENT_KINDS.items():
        c = F.when(F.col("event_type") == et, F.lit(code)).otherwise(c)
    return c


_KIND_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_KINDS.items()) + " END"


def _router_sql(mode: str, kinds) -> str:
    return f"""
SELECT event_id, MessageCode, 'message' || CAST(MessageCode AS VARCHAR) || '_json_{mode}' AS topic
FROM (SELECT event_id, {_KIND_SQL} AS MessageCode FROM events)
WHERE MessageCode IN ({", ".join(str(k) for k in kinds)})
"""


@register("topic_router", sql=_router_sql("full", [1501, 1502, 1505, 1507, 1510, 1512, 1105]),
          ids=("F5", "C6", "W8", "X8"))
def q_topic_router(spark, sf_dir):
    """Route every message to ``message<code>_json_full`` (one job writes all topics)."""
    ev = table(spark, sf_dir, "events").select("event_id", _kind_col().alias("MessageCode"))
    return route(ev, mode="full")


@register("topic_router_partial", sql=_router_sql("partial", [1501, 1502, 1505, 1510, 1512, 1105]),
          ids=("F5",))
def q_topic_router_partial(spark, sf_dir):
    """Partial mode publishes no market-status (1507) messages."""
    ev = table(spark, sf_dir, "events").select("event_id", _kind_col().alias("MessageCode"))
    return route(ev, mode="partial")


# Kinds dealt to events by id, so that every kind, an unknown one and a missing one occur.
ALL_KINDS = [1501, 1502, 1505, 1507, 1510, 1512, 1105, 9999]


@register("topic_router_all", sql=f"""
SELECT *, CASE WHEN (mode = 'full' AND MessageCode IN (1501, 1502, 1505, 1507, 1510, 1512, 1105))
               OR (mode = 'partial' AND MessageCode IN (1501, 1502, 1505, 1510, 1512, 1105))
          THEN 'message' || CAST(MessageCode AS VARCHAR) || '_json_' || mode ELSE 'message_dead_letter' END AS topic
FROM (SELECT event_id, CASE event_id % 9 {" ".join(f"WHEN {i} THEN {k}" for i, k in enumerate(ALL_KINDS))} END
               AS MessageCode, CASE WHEN user_id % 2 = 0 THEN 'full' ELSE 'partial' END AS mode FROM events)
""", ids=("F5", "X8", "X10"))
def q_topic_router_all(spark, sf_dir):
    """All kinds in both modes routed to their 13 topics; unpublished, unknown and missing kinds to dead letters."""
    kinds = F.array(*[F.lit(k) for k in ALL_KINDS], F.lit(None).cast("int"))
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.get(kinds, (F.col("event_id") % 9).cast("int")).alias("MessageCode"),
        F.when(F.col("user_id") % 2 == 0, F.lit("full")).otherwise(F.lit("partial")).alias("mode"))
    return route_all(ev)


@register("bus_records", sql=f"""
SELECT '2_' || CAST(user_id AS VARCHAR) AS key, topic, event_id, value AS price
FROM (SELECT *, 'message' || CAST({_KIND_SQL} AS VARCHAR) || '_json_full' AS topic FROM events)
""", ids=("K2", "X16", "P15", "M5"))
def q_bus_records(spark, sf_dir):
    """Bus records (key = segment_instrument, JSON value, topic per row), value decoded back."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", _kind_col().alias("MessageCode"), F.lit(2).alias("ExchangeSegment"),
        F.col("user_id").cast("int").alias("ExchangeInstrumentID"), F.col("value").alias("LastTradedPrice"))
    recs = kafka_records(route(ev, mode="full"), ["ExchangeSegment", "ExchangeInstrumentID"],
                         ["event_id", "LastTradedPrice"], topic_col="topic")
    return recs.select("key", "topic",
                       F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
                       F.get_json_object("value", "$.LastTradedPrice").cast("double").alias("price"))


SUBSCRIBED = [(2, 1), (2, 5), (2, 8), (2, 42), (2, 77), (2, 120), (2, 149)]
WITHDRAWN = [(2, 8), (2, 42)]
_KEYS = ["ExchangeSegment", "ExchangeInstrumentID"]
_SUB_COLS = ["event_id", "ExchangeSegment", "ExchangeInstrumentID", "LastTradedPrice",
             "LastTradedQunatity", "LastUpdateTime"]
_SUB_SQL = f"""
SELECT event_id, 2 AS ExchangeSegment, CAST(user_id AS INTEGER) AS ExchangeInstrumentID,
       value AS LastTradedPrice, {SQL_EVENT_QTY} AS LastTradedQunatity,
       epoch_us(ts) // 1000000 - 315532800 AS LastUpdateTime
FROM events WHERE user_id {{op}} ({{ids}})
"""


def _decoded_feed(spark, sf_dir):
    msgs = feed1_messages(table(spark, sf_dir, "events"))
    return decode(msgs, bytes_to_text("value"), TICK_FEED1, keep=["event_id"]).select(*_SUB_COLS)


@register("subscription_filter", sql=_SUB_SQL.format(op="IN", ids=", ".join(str(i) for _, i in SUBSCRIBED)),
          ids=("F3",))
def q_subscription_filter(spark, sf_dir):
    """Decoded feed semi-joined with the subscribed (segment, instrument) pairs."""
    subs = request_table(spark, SUBSCRIBED, "ExchangeSegment int, ExchangeInstrumentID int")
    return subscribe(_decoded_feed(spark, sf_dir), subs, _KEYS)


@register("unsubscription_filter",
          sql=_SUB_SQL.format(op="NOT IN", ids=", ".join(str(i) for _, i in WITHDRAWN)), ids=("F4",))
def q_unsubscription_filter(spark, sf_dir):
    """Decoded feed without the withdrawn pairs (left anti join)."""
    gone = request_table(spark, WITHDRAWN, "ExchangeSegment int, ExchangeInstrumentID int")
    return unsubscribe(_decoded_feed(spark, sf_dir), gone, _KEYS)


@register("quote_snapshot", sql=f"""
SELECT event_type AS instrument, last(ts ORDER BY ts, event_id) AS ts,
       last(value ORDER BY ts, event_id) AS price,
       last({SQL_EVENT_QTY} ORDER BY ts, event_id) AS qty,
       last(event_id ORDER BY ts, event_id) AS seq, count(*) AS updates
FROM events GROUP BY event_type
""", ids=("Q1",))
def q_quote_snapshot(spark, sf_dir):
    """Latest tick per instrument."""
    return O.quote_snapshot(event_ticks(table(spark, sf_dir, "events")))


_STATE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ORDER_STATES.items()) + " END"
_ORDERS_SQL = f"""
SELECT 'CL' || printf('%04d', user_id // 10) AS clientID, user_id AS appOrderID,
       {_STATE_SQL} AS state, CAST(json_extract_string(props, '$.k') AS BIGINT) AS filled_quantity,
       value AS filled_price, ts, event_id AS seq
FROM events
"""


QUOTE_KIND = 1512


@register("quote_snapshot_listed", sql=f"""
SELECT CAST(user_id AS BIGINT) AS instrument, last(ts ORDER BY ts, event_id) AS ts,
       last(value ORDER BY ts, event_id) AS price, last(event_id ORDER BY ts, event_id) AS seq, count(*) AS updates
FROM events WHERE {_KIND_SQL} = {QUOTE_KIND} AND user_id IN ({", ".join(str(i) for _, i in SUBSCRIBED)})
GROUP BY user_id
""", ids=("Q1",))
def q_quote_snapshot_listed(spark, sf_dir):
    """Latest tick of one message kind for a list of instruments (the service's arguments)."""
    kinds = [et for et, code in EVENT_KINDS.items() if code == QUOTE_KIND]  # on the stored column: the scan filters
    ticks = table(spark, sf_dir, "events").where(F.col("event_type").isin(kinds)).select(
        F.col("user_id").alias("instrument"), "ts", F.col("value").alias("price"), F.col("event_id").alias("seq"))
    listed = request_table(spark, [(i,) for _, i in SUBSCRIBED], "instrument bigint")
    return O.quote_snapshot(ticks, subscriptions=listed)


CLIENT = "CL0003"


@register("order_book", sql=f"""
SELECT appOrderID, last(clientID ORDER BY ts, seq) AS clientID, last(state ORDER BY ts, seq) AS state,
       last(filled_quantity ORDER BY ts, seq) AS filled_quantity,
       last(filled_price ORDER BY ts, seq) AS filled_price,
       max(ts) AS ts, last(seq ORDER BY ts, seq) AS seq, count(*) AS updates
FROM ({_ORDERS_SQL}) WHERE clientID = '{CLIENT}' GROUP BY appOrderID
""", ids=("R1",))
def q_order_book(spark, sf_dir):
    """Current state of every order of one client (the service's argument)."""
    return O.order_book(event_orders(table(spark, sf_dir, "events"), CLIENT), client_id=CLIENT)


@register("dealer_order_book", sql=f"""
SELECT appOrderID, last(clientID ORDER BY ts, seq) AS clientID, last(state ORDER BY ts, seq) AS state,
       last(filled_quantity ORDER BY ts, seq) AS filled_quantity,
       last(filled_price ORDER BY ts, seq) AS filled_price,
       max(ts) AS ts, last(seq ORDER BY ts, seq) AS seq, count(*) AS updates
FROM ({_ORDERS_SQL}) GROUP BY appOrderID
""", ids=("R2",))
def q_dealer_order_book(spark, sf_dir):
    """Dealer order book: every client's orders (no client filter; equals the all-client order_book)."""
    return O.order_book(event_orders(table(spark, sf_dir, "events")), client_id=None)


@register("order_history", sql=f"""
SELECT clientID, appOrderID, ts, seq, state,
       lag(state) OVER w AS prev_state, row_number() OVER w AS step
FROM ({_ORDERS_SQL})
WINDOW w AS (PARTITION BY appOrderID ORDER BY ts, seq)
""", ids=("R3",))
def q_order_history(spark, sf_dir):
    """State chain of every order with previous state and step (skew-safe sequence)."""
    return O.order_history(event_orders(table(spark, sf_dir, "events")))


ORDER_ID = 42


@register("order_history_one", sql=f"""
SELECT clientID, appOrderID, ts, seq, state,
       lag(state) OVER w AS prev_state, row_number() OVER w AS step
FROM ({_ORDERS_SQL}) WHERE appOrderID = {ORDER_ID}
WINDOW w AS (PARTITION BY appOrderID ORDER BY ts, seq)
""", ids=("R3",))
def q_order_history_one(spark, sf_dir):
    """State chain of one order (the service's argument)."""
    return O.order_history(event_orders(table(spark, sf_dir, "events")), order_id=ORDER_ID)


_FILLS_SQL = """
SELECT o.o_custkey AS clientID, l.l_orderkey AS appOrderID, l.l_linenumber AS fill_no,
       l.l_suppkey AS counterparty, l.l_partkey AS instrument,
       CASE WHEN l.l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
       l.l_quantity AS qty, l.l_extendedprice AS amount, o.o_orderstatus AS status,
       l.l_shipdate AS trade_ts, CAST(l.l_shipdate AS DATE) AS trade_day
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus IN ('F', 'P')
"""


def _fills(spark, sf_dir):
    return trade_fills(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


TRADE_CLIENT, TRADE_DAY = 3, "1999-10-02"


@register("trade_book", sql=f"""
SELECT * FROM ({_FILLS_SQL}) WHERE clientID = {TRADE_CLIENT} AND trade_day = DATE '{TRADE_DAY}'
""", ids=("R4",))
def q_trade_book(spark, sf_dir):
    """Fills and part fills of one client on one day (the service's arguments)."""
    return O.trade_book(_fills(spark, sf_dir), client_id=TRADE_CLIENT, day=TRADE_DAY)


@register("dealer_trade_book", sql=_FILLS_SQL, ids=("R5",))
def q_dealer_trade_book(spark, sf_dir):
    """Dealer trade book: fills of every client and day (no filters; equals the all-client trade_book)."""
    return O.trade_book(_fills(spark, sf_dir), client_id=None, day=None)


def _positions_sql(keys: list[str], where: str = "", having: str = "") -> str:
    k = ", ".join(keys)
    return f"""
SELECT {k},
       sum(CASE WHEN side = 'BUY' THEN qty ELSE 0.0 END) AS bought_qty,
       sum(CASE WHEN side = 'SELL' THEN qty ELSE 0.0 END) AS sold_qty,
       sum(CASE WHEN side = 'BUY' THEN qty ELSE 0.0 END) - sum(CASE WHEN side = 'SELL' THEN qty ELSE 0.0 END)
         AS net_qty,
       CAST(sum(CASE WHEN side = 'BUY' THEN CAST(amount AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS bought_value,
       CAST(sum(CASE WHEN side = 'SELL' THEN CAST(amount AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS sold_value,
       CAST(sum(CASE WHEN side = 'SELL' THEN CAST(amount AS DECIMAL(18,4)) ELSE 0 END)
          - sum(CASE WHEN side = 'BUY' THEN CAST(amount AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS net_value,
       count(*) AS trades
FROM ({_FILLS_SQL}) f {where}
GROUP BY {k} {having}
"""


@register("positions_day", sql=_positions_sql(["clientID", "instrument", "trade_day"]), ids=("R6",))
def q_positions_day(spark, sf_dir):
    """Day-wise positions per client and instrument."""
    return O.positions(_fills(spark, sf_dir), day_wise=True)


@register("positions_net", sql=_positions_sql(["clientID", "instrument"]), ids=("R7",))
def q_positions_net(spark, sf_dir):
    """Net-wise positions per client and instrument."""
    return O.positions(_fills(spark, sf_dir))


@register("dealer_positions_day", sql=_positions_sql(["instrument", "trade_day"]), ids=("R8",))
def q_dealer_positions_day(spark, sf_dir):
    """Dealer view: day-wise positions per instrument across all clients."""
    return O.positions(_fills(spark, sf_dir), by=("instrument",), day_wise=True)


@register("dealer_positions_net", sql=_positions_sql(["instrument"]), ids=("R8",))
def q_dealer_positions_net(spark, sf_dir):
    """Dealer view: net positions per instrument across all clients."""
    return O.positions(_fills(spark, sf_dir), by=("instrument",))


HOLDING_CUTOFF = "1999-01-01"


@register("holdings", sql=_positions_sql(
    ["clientID", "instrument"], where=f"WHERE trade_ts < TIMESTAMP '{HOLDING_CUTOFF}'",
    having="HAVING sum(CASE WHEN side = 'BUY' THEN qty ELSE 0.0 END) "
           "- sum(CASE WHEN side = 'SELL' THEN qty ELSE 0.0 END) > 0"), ids=("R9",))
def q_holdings(spark, sf_dir):
    """Long-term holdings: positive net positions from trades before the cutoff day."""
    return O.holdings(_fills(spark, sf_dir), HOLDING_CUTOFF)


# ---- quality ---------------------------------------------------------------------

_Q_COLS = [("event_id", "bigint"), ("ExchangeInstrumentID", "int"), ("LastTradedPrice", "double"),
           ("LastTradedQunatity", "int"), ("LastUpdateTime", "bigint"), ("_reason", "string")]


def _quarantine_sql():
    from tickweave.plans.catalog import REGISTRY
    return REGISTRY["tick_quarantine"].sql


@register("quality_missing", sql="WITH r AS (" + _quarantine_sql() + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null, count(*) AS rows, "
    f"1.0 - count({c}) / count(*) AS null_rate FROM r" for c, t in _Q_COLS), ids=("D1",))
def q_quality_missing(spark, sf_dir):
    """Per-column NULL rate of the decoded (partly spoilt) feed."""
    return Q.missing_report(q_tick_quarantine(spark, sf_dir))


@register("quality_anomaly", sql="""
SELECT event_id, event_type AS instrument, value AS price,
       round((value - m) / s, 6) AS z
FROM events JOIN (SELECT event_type AS k, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY 1)
  ON event_type = k
WHERE s > 0 AND abs((value - m) / s) > 3
""", ids=("D2",))
def q_quality_anomaly(spark, sf_dir):
    """Ticks more than 3 population standard deviations from their instrument's mean."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("instrument"),
                                                F.col("value").alias("price"))
    return Q.zscore_outliers(ev, "instrument", "price").withColumn("z", F.round("z", 6))


@register("quality_bar_rules", sql="WITH b AS (" + _event_bar_sql(3600) + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, count(*) FILTER (WHERE coalesce({c}, false)) AS flagged, count(*) AS checked FROM b"
    for n, c in Q.BAR_RULES.items()), ids=("D2",))
def q_quality_bar_rules(spark, sf_dir):
    """Rule checks on hourly bars (price <= 0, high < low, open/close outside range, volume < 0)."""
    return Q.bar_rule_counts(ohlcv(event_ticks(table(spark, sf_dir, "events")), "1 hour"))


@register("quality_handled", sql="""
SELECT event_id, ExchangeInstrumentID, LastTradedPrice,
       coalesce(LastTradedQunatity, 0) AS LastTradedQunatity, LastUpdateTime, _reason
FROM (""" + _quarantine_sql() + """)
WHERE ExchangeInstrumentID IS NOT NULL AND LastUpdateTime IS NOT NULL
""", ids=("D1",))
def q_quality_handled(spark, sf_dir):
    """Missing values handled by rule: rows without keys dropped, missing quantity filled with 0."""
    return Q.handle_missing(q_tick_quarantine(spark, sf_dir), required=["ExchangeInstrumentID", "LastUpdateTime"],
                            fill={"LastTradedQunatity": 0})
