"""Decode queries: JSON / Python-repr / double-encoded payloads, quarantine, tick lists, time fields."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from tickweave.functions import text as T
from tickweave.functions import timeutil as TU
from tickweave.operators.bars import ohlcv
from tickweave.operators.decode import (bytes_to_text, decode, decode_checked, explode_ticks, explode_ticks_checked,
                                        prune_tick, to_json_text, wrap_json_string)
from tickweave.plans.catalog import SQL_EVENT_QTY, register, sql_bucket
from tickweave.schemas import CANDLE, TICK_FEED1, TICK_FEED2, TICK_FEED2_RAW
from tickweave.sources.messages import (event_k, feed1_fields, feed1_messages, feed2_tick_lists,
                                        python_repr_messages, python_string)
from tickweave.sources.tables import table

_FEED1_SQL = f"""
       1512 AS MessageCode, 4 AS MessageVersion, 0 AS ApplicationType, 0 AS TokenID,
       2 AS ExchangeSegment, CAST(user_id AS INTEGER) AS ExchangeInstrumentID,
       1 AS BookType, 1 AS XMarketType, value AS LastTradedPrice,
       {SQL_EVENT_QTY} AS LastTradedQunatity,
       epoch_us(ts) // 1000000 - 315532800 AS LastUpdateTime"""


@register("tick_json_decode", sql=f"""
SELECT event_id, {_FEED1_SQL}, CAST(NULL AS VARCHAR) AS _corrupt_record
FROM events
""", ids=("S2", "P1", "P2", "P15", "M5", "C8"))
def q_tick_json_decode(spark, sf_dir):
    """Feed-1 messages as bus bytes -> text -> fixed-schema decode -> flat columns."""
    msgs = feed1_messages(table(spark, sf_dir, "events"))
    return decode(msgs, bytes_to_text("value"), TICK_FEED1, keep=["event_id"])


REPR_SCHEMA = StructType([StructField("event_id", LongType()), StructField("event_type", StringType()),
                          StructField("value", DoubleType()), StructField("k", IntegerType()),
                          StructField("big", BooleanType()), StructField("note", StringType())])


@register("tick_repr_decode", sql=f"""
SELECT event_id AS id, event_id, event_type, value, {SQL_EVENT_QTY} AS k, value > 100 AS big,
       CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'u' || CAST(user_id AS VARCHAR) END AS note,
       CAST(NULL AS VARCHAR) AS _corrupt_record
FROM events
""", ids=("P3", "M4"))
def q_tick_repr_decode(spark, sf_dir):
    """Python ``str(dict)`` payloads: literals read as JSON, strings left alone, one parse a row."""
    msgs = python_repr_messages(table(spark, sf_dir, "events")).withColumnRenamed("event_id", "id")
    return decode(msgs, "value", REPR_SCHEMA, keep=["id"], python_repr=True)


# Notes that look like literals, hold quotes, blanks and escapes, in turn; the last two are a value None
# and an escape without a character (half of a surrogate pair), which is quarantined.
_NOTES = [", None, y", ": True}, [False, nan]", " it's", ' says "hi", None', ' it\'s "both": None,',
          " C:\\new\\table\\\n\tNone\r", " bell \x07 é 漢 😀"]


def _sql_text(text: str) -> str:
    """A text as a DuckDB expression, control characters by number."""
    return " || ".join(f"chr({ord(c)})" if c < " " else "'" + c.replace("'", "''") + "'" for c in text)


@register("tick_repr_quoted", sql=f"""
SELECT event_id AS id, CASE WHEN kind < 8 THEN event_id END AS event_id, CASE WHEN kind < 8 THEN event_type END AS event_type,
       CASE WHEN kind < 8 THEN value END AS value, CASE WHEN kind < 8 THEN {SQL_EVENT_QTY} END AS k,
       CASE WHEN kind < 8 THEN value > 100 END AS big,
       CASE {" ".join(f"WHEN kind = {i} THEN 'u' || user_id || {_sql_text(n)}" for i, n in enumerate(_NOTES))} END AS note,
       CASE WHEN kind = 8 THEN 'malformed' END AS _reason
FROM (SELECT *, event_id % 9 AS kind FROM events)
""", ids=("P3", "M4", "D4", "X10"))
def q_tick_repr_quoted(spark, sf_dir):
    """Python ``str(dict)`` payloads whose strings hold literals, quotes and escapes; a reason where one has no text."""
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    kind = F.col("event_id") % 9
    note = F.when(kind == len(_NOTES), F.lit("None")).when(kind == len(_NOTES) + 1, F.lit("'half \\ud83d pair'"))
    for i, n in enumerate(_NOTES):
        note = note.when(kind == i, python_string(F.concat(user, F.lit(n))))
    msgs = python_repr_messages(table(spark, sf_dir, "events"), note).withColumnRenamed("event_id", "id")
    checked = decode_checked(msgs, "value", REPR_SCHEMA, required=["event_id"], keep=["id"], python_repr=True)
    return checked.drop("_corrupt_record")


REENC_SCHEMA = StructType([StructField("event_id", LongType()), StructField("event_type", StringType()),
                           StructField("value", DoubleType()), StructField("k", IntegerType())])


@register("tick_reencode_decode", sql=f"""
SELECT event_id, event_type, value, {SQL_EVENT_QTY} AS k, CAST(NULL AS VARCHAR) AS _corrupt_record
FROM events
""", ids=("P14", "P15", "M5", "C8", "X7"))
def q_tick_reencode_decode(spark, sf_dir):
    """Payload JSON-encoded twice (a JSON string holding JSON), sent as bytes, unwrapped once."""
    ev = table(spark, sf_dir, "events")
    inner = to_json_text("event_id", "event_type", "value", event_k().alias("k"))
    msgs = ev.select(F.encode(wrap_json_string(inner), "UTF-8").alias("value"))
    return decode(msgs, bytes_to_text("value"), REENC_SCHEMA, unwrap=True)


# Spoilt payloads: every 7th event id, four kinds in turn.
#   0 -> not JSON at all; 1 -> text in the price field; 2 -> Python None as a value;
#   3 -> NULL payload (decodes to all NULL without being corrupt: caught as a NULL key)
def _spoil_kind():
    return F.when(F.col("event_id") % 7 == 0, F.expr("event_id div 7") % 4)


def spoilt_feed1_text():
    """Feed-1 payload text of an events row, spoilt for every 7th event id."""
    good = to_json_text(*feed1_fields())
    bad_price = to_json_text(*feed1_fields(LastTradedPrice=F.lit("abc")))
    kind = _spoil_kind()
    return (F.when(kind == 0, F.lit("hello"))
            .when(kind == 1, bad_price)
            .when(kind == 2, F.regexp_replace(good, '"BookType":1', '"BookType":None'))
            .when(kind == 3, F.lit(None).cast("string"))
            .otherwise(good))


@register("tick_quarantine", sql=f"""
SELECT event_id,
       CASE WHEN kind IN (0, 2, 3) THEN NULL ELSE CAST(user_id AS INTEGER) END AS ExchangeInstrumentID,
       CASE WHEN kind IN (0, 1, 2, 3) THEN NULL ELSE value END AS LastTradedPrice,
       CASE WHEN kind IN (0, 2, 3) THEN NULL ELSE {SQL_EVENT_QTY} END AS LastTradedQunatity,
       CASE WHEN kind IN (0, 2, 3) THEN NULL ELSE epoch_us(ts) // 1000000 - 315532800 END AS LastUpdateTime,
       CASE WHEN kind IN (0, 1, 2) THEN 'malformed' WHEN kind = 3 THEN 'null_key' END AS _reason
FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN (event_id // 7) % 4 END AS kind FROM events)
""", ids=("P1", "X10", "X26", "D4"))
def q_tick_quarantine(spark, sf_dir):
    """Decode with quarantine: malformed text and NULL keys get a reason, clean rows none."""
    ev = table(spark, sf_dir, "events")
    text = spoilt_feed1_text()
    checked = decode_checked(ev.select("event_id", text.alias("value")), "value", TICK_FEED1,
                             required=["ExchangeInstrumentID", "LastUpdateTime"], keep=["event_id"])
    return checked.select("event_id", "ExchangeInstrumentID", "LastTradedPrice",
                          "LastTradedQunatity", "LastUpdateTime", "_reason")


_TICK_OUT = [f.name for f in TICK_FEED2.fields]


def _tick_list_sql(first_only: bool) -> str:
    where = "WHERE pos = 0" if first_only else ""
    return f"""
SELECT list_id, pos, mode, instrument_token, last_price, last_traded_quantity, average_traded_price,
       volume_traded, total_buy_quantity, total_sell_quantity, change, last_trade_time,
       oi, oi_day_high, oi_day_low, exchange_timestamp, has_depth,
       CAST(exchange_timestamp AS TIMESTAMP) AS exchange_ts
FROM (
  SELECT event_id // 4 AS list_id,
         CAST(row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id) - 1 AS INTEGER) AS pos,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'full' ELSE 'quote' END AS mode,
         user_id AS instrument_token, value AS last_price, {SQL_EVENT_QTY} AS last_traded_quantity,
         value AS average_traded_price, event_id AS volume_traded,
         CAST({SQL_EVENT_QTY} AS BIGINT) * 2 AS total_buy_quantity,
         CAST({SQL_EVENT_QTY} AS BIGINT) * 3 AS total_sell_quantity,
         0.0::DOUBLE AS change, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_trade_time,
         CAST(NULL AS BIGINT) AS oi, CAST(NULL AS BIGINT) AS oi_day_high, CAST(NULL AS BIGINT) AS oi_day_low,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS exchange_timestamp,
         event_type IN ('purchase', 'click') AS has_depth
  FROM events) {where}
"""


def _tick_lists(spark, sf_dir, first_only):
    lists = feed2_tick_lists(table(spark, sf_dir, "events"))
    ticks = prune_tick(explode_ticks(lists, "value", TICK_FEED2_RAW, keep=["list_id"], first_only=first_only))
    return ticks.select("list_id", "pos", *_TICK_OUT, "has_depth",
                        TU.text_to_time("exchange_timestamp").alias("exchange_ts"))


@register("tick_list_prune", sql=_tick_list_sql(False), ids=("P4", "M2", "M3", "T10", "X24"))
def q_tick_list_prune(spark, sf_dir):
    """Feed-2 callback lists: every tick of a list, nested parts dropped, times as text then parsed."""
    return _tick_lists(spark, sf_dir, first_only=False)


@register("tick_list_first", sql=_tick_list_sql(True), ids=("P4", "M3", "X9"))
def q_tick_list_first(spark, sf_dir):
    """The producer's old rule: only element 0 of each callback list."""
    return _tick_lists(spark, sf_dir, first_only=True)


@register("tick_list_checked", sql=f"""
SELECT list_id, pos, instrument_token, last_price, CAST(NULL AS VARCHAR) AS _reason
FROM ({_tick_list_sql(False)}) WHERE list_id % 5 NOT IN (0, 1)
UNION ALL
SELECT list_id, pos, instrument_token, CASE WHEN pos = 0 THEN NULL ELSE last_price END, CASE WHEN pos = 0 THEN 'malformed' END
FROM ({_tick_list_sql(False)}) WHERE list_id % 5 = 1
UNION ALL
SELECT DISTINCT event_id // 4, CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), 'bad_list'
FROM events WHERE (event_id // 4) % 5 = 0
""", ids=("P4", "M3", "X10", "X26", "D4"))
def q_tick_list_checked(spark, sf_dir):
    """Partly spoilt callback lists: every tick or list comes back, with a reason where it does not decode."""
    lists = feed2_tick_lists(table(spark, sf_dir, "events"))
    kind = F.col("list_id") % 5  # 0: the list is cut off; 1: the price of its first tick is text
    bad_price = F.regexp_replace("value", r'^(\[\{.*?"last_price":)[-0-9.E]+', '$1"abc"')
    spoilt = lists.withColumn("value", F.when(kind == 0, F.lit('{"not": "a list')).when(kind == 1, bad_price)
                              .otherwise(F.col("value")))
    out = explode_ticks_checked(spoilt, "value", TICK_FEED2_RAW, required=["instrument_token"], keep=["list_id"])
    return out.select("list_id", "pos", "instrument_token", "last_price", "_reason")


@register("epoch1980_decode", sql="""
SELECT event_id,
       epoch_us(ts) // 1000000 - 315532800 AS LastUpdateTime,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts_utc,
       strftime(make_timestamp((epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%d %H:%M:%S') AS unix_text,
       replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '_') AS day_tag,
       strftime(date_trunc('minute', ts), '%H:%M:%S') AS minute_label
FROM events
""", ids=("T1", "T2", "T3", "T6", "T7", "C7"))
def q_epoch1980_decode(spark, sf_dir):
    """Seconds since 1980 -> UTC time, day tag, minute label; plain Unix seconds -> text."""
    ev = table(spark, sf_dir, "events").select("event_id", TU.to_epoch1980("ts").alias("LastUpdateTime"))
    ts = TU.from_epoch1980("LastUpdateTime")
    return ev.select(
        "event_id", "LastUpdateTime", ts.alias("ts_utc"),
        F.from_unixtime(F.col("LastUpdateTime") + 315532800).alias("unix_text"),
        F.replace(ts.cast("date").cast("string"), F.lit("-"), F.lit("_")).alias("day_tag"),
        TU.clock_label(TU.truncate_minute(ts), "HH:mm:ss").alias("minute_label"))


@register("compound_key_split", sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(l_linenumber AS VARCHAR) || '_' || CAST(l_partkey AS VARCHAR) AS t,
       l_linenumber AS segment, l_partkey AS instrument
FROM lineitem
""", ids=("P7", "C2", "C6"))
def q_compound_key_split(spark, sf_dir):
    """``segment_instrument`` keys built and split back into typed parts."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    li = li.withColumn("t", T.compound_key("l_linenumber", "l_partkey"))
    return li.withColumn("k", T.split_compound_key("t")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "t", "k.segment", "k.instrument")


@register("depth_info_split", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS size, l_extendedprice AS price,
       CAST(l_linenumber AS BIGINT) AS orders
FROM lineitem
""", ids=("P8", "C2"))
def q_depth_info_split(spark, sf_dir):
    """Best ask/bid text ``size|price|orders`` parsed into typed fields."""
    li = table(spark, sf_dir, "lineitem")
    ai = T.depth_text(F.col("l_quantity").cast("long"), "l_extendedprice", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber", T.split_depth(ai).alias("d")).select(
        "l_orderkey", "l_linenumber", "d.size", "d.price", "d.orders")


@register("candle_decode", sql=f"""
SELECT 2 AS segment, CAST(user_id AS BIGINT) AS instrument,
       {sql_bucket('ts', 3600)} AS bt,
       first(value ORDER BY ts, event_id) AS o, max(value) AS h, min(value) AS l,
       last(value ORDER BY ts, event_id) AS c,
       CAST(sum({SQL_EVENT_QTY}) AS BIGINT) AS bv,
       CAST(sum(CAST(value AS DECIMAL(18,4)) * {SQL_EVENT_QTY}) AS DOUBLE) AS pv,
       CAST(NULL AS VARCHAR) AS _corrupt_record
FROM events WHERE ts IS NOT NULL
GROUP BY user_id, 3
""", ids=("X6", "X7", "P7", "P14", "W5"))
def q_candle_decode(spark, sf_dir):
    """Vendor candle messages (JSON-encoded twice by the producer) unwrapped, decoded, key split."""
    out = decode(candle_messages(spark, sf_dir), bytes_to_text("value"), CANDLE, unwrap=True)
    return out.select(T.split_compound_key("t").alias("k"), "*").select(
        "k.segment", "k.instrument", F.col("bt").cast("timestamp_ntz").alias("bt"),
        "o", "h", "l", "c", "bv", "pv", "_corrupt_record")


def candle_messages(spark, sf_dir):
    """(value bytes) hourly candles per user as the vendor sends them, JSON-encoded twice."""
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.col("user_id").alias("instrument"), "ts", F.col("value").alias("price"),
                      event_k().alias("qty"), F.col("event_id").alias("seq"),
                      (F.col("value").cast("decimal(18,4)") * event_k()).alias("pq"))
    bars = ohlcv(ticks, "1 hour", extra_aggs={"pv": F.sum("pq").cast("double")})
    candle = to_json_text(T.compound_key(F.lit(2), "instrument").alias("t"), F.col("open").alias("o"),
                          F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"),
                          F.col("bar_start").cast("timestamp").alias("bt"), F.col("volume").alias("bv"), "pv")
    return bars.select(F.encode(wrap_json_string(candle), "UTF-8").alias("value"))


@register("touchline_decode", sql=f"""
SELECT event_id, '2_' || CAST(user_id AS VARCHAR) AS t, value AS ltp, CAST({SQL_EVENT_QTY} AS BIGINT) AS ltq,
       CAST({SQL_EVENT_QTY} AS BIGINT) * 10 AS ask_size, value + 0.05 AS ask_price, CAST(1 AS BIGINT) AS ask_orders,
       CAST({SQL_EVENT_QTY} AS BIGINT) * 20 AS bid_size, value - 0.05 AS bid_price, CAST(2 AS BIGINT) AS bid_orders,
       ts AS ltt
FROM events
""", ids=("P8", "P7", "C2"))
def q_touchline_decode(spark, sf_dir):
    """Compact touchline messages decoded; best ask / bid ``size|price|orders`` split into fields."""
    from tickweave.schemas import TOUCHLINE

    ev = table(spark, sf_dir, "events")
    k = event_k().cast("long")
    ask = T.depth_text(k * 10, F.col("value") + 0.05, F.lit(1))
    bid = T.depth_text(k * 20, F.col("value") - 0.05, F.lit(2))
    msg = to_json_text(T.compound_key(F.lit(2), "user_id").alias("t"), F.col("value").alias("ltp"),
                       k.alias("ltq"), F.col("ts").cast("timestamp").alias("ltt"),
                       ask.alias("ai"), bid.alias("bi"))
    out = decode(ev.select("event_id", msg.alias("value")), "value", TOUCHLINE, keep=["event_id"])
    return out.select("event_id", "t", "ltp", "ltq",
                      T.split_depth("ai").alias("a"), T.split_depth("bi").alias("b"),
                      F.col("ltt").cast("timestamp_ntz").alias("ltt")).select(
        "event_id", "t", "ltp", "ltq", F.col("a.size").alias("ask_size"), F.col("a.price").alias("ask_price"),
        F.col("a.orders").alias("ask_orders"), F.col("b.size").alias("bid_size"),
        F.col("b.price").alias("bid_price"), F.col("b.orders").alias("bid_orders"), "ltt")
