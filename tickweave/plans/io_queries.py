"""Streaming landing, live bars, and file / table round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions.text import split_compound_key
from tickweave.functions.timeutil import from_epoch1980, stamp_text, text_to_time
from tickweave.operators.bars import ohlcv
from tickweave.operators.broker import decode_broker_bars, encode_broker_responses
from tickweave.operators.decode import (
    bytes_to_text, decode_checked, explode_ticks_checked, prune_tick, to_json_text, with_status,
)
from tickweave.operators.reconcile import reconcile_volume
from tickweave.plans.bar_queries import _event_bar_sql
from tickweave.plans.catalog import REGISTRY, SQL_EVENT_QTY, register, sql_bucket
from tickweave.plans.decode_queries import candle_messages, spoilt_feed1_text
from tickweave.schemas import CANDLE, TICK_FEED1, TICK_FEED2, TICK_FEED2_RAW
from tickweave.session import work_path, work_table
from tickweave.sinks.files import append_json_lines, append_table, cluster_for_partitioned_write, write_csv
from tickweave.sources.files import read_bar_csv, read_csv, read_json_lines, read_landed
from tickweave.sources.messages import event_k, feed1_fields, feed2_tick_lists
from tickweave.sources.tables import event_ticks, table
from tickweave.streaming.correction import bars_by_day, correct_bars, touched_days, write_bars
from tickweave.streaming.landing import land, land_checked, observed, progress_summary, with_ingest_date
from tickweave.streaming.live_bars import live_bars
from tickweave.streaming.sources import file_stream

_EVENTS_COLS = "event_id, ts, user_id, event_type, value, props"


def _events_stream(spark, sf_dir):
    """The events table as a file stream (stands in for the bus topic)."""
    schema = table(spark, sf_dir, "events").schema
    return file_stream(spark, sf_dir, schema, glob="events.parquet")


@register("tick_landing_stream", sql=f"""
SELECT event_id, 1512 AS MessageCode, 4 AS MessageVersion, 0 AS ApplicationType, 0 AS TokenID,
       2 AS ExchangeSegment, CAST(user_id AS INTEGER) AS ExchangeInstrumentID,
       1 AS BookType, 1 AS XMarketType, value AS LastTradedPrice,
       {SQL_EVENT_QTY} AS LastTradedQunatity,
       epoch_us(ts) // 1000000 - 315532800 AS LastUpdateTime,
       strftime(ts, '%Y_%m_%d') AS ingest_date
FROM events
""", ids=("S1", "K1", "K7", "W2", "W3", "W4", "W6", "S8", "S9", "S3", "S4", "X11", "X14", "X15", "X17"))
def q_tick_landing_stream(spark, sf_dir):
    """Stream payloads -> decode -> Parquet partitioned by tick day (checkpointed), read back."""
    root = work_path(spark, "landing")
    msgs = _events_stream(spark, sf_dir).select(
        "event_id", F.encode(to_json_text(*feed1_fields()), "UTF-8").alias("value"))
    return _land_feed1(spark, msgs, bytes_to_text("value"), root).drop("status")


FEED1_KEYS = ["ExchangeInstrumentID", "LastUpdateTime"]


def _land_feed1(spark, msgs, text, root, status="clean"):
    """Feed-1 messages landed by a stream, clean and quarantined rows apart; one side (or both) read back."""
    checked = decode_checked(msgs, text, TICK_FEED1, required=FEED1_KEYS, keep=["event_id"])
    checked = observed(with_ingest_date(checked, from_epoch1980("LastUpdateTime")))
    q = land_checked(checked, f"{root}/data", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    landed = read_landed(spark, f"{root}/data", schema=with_status(checked).schema)
    if status is None:
        return landed
    return landed.where(F.col("status") == status).drop("_corrupt_record", "_reason")


STREAM_DELAY_MIN = 5


@register("ohlcv_bars_stream", sql=f"""
SELECT * FROM ({_event_bar_sql(3600)})
WHERE bar_end <= (SELECT max(ts) FROM events) - INTERVAL {STREAM_DELAY_MIN} MINUTE
""", ids=("W1", "W5", "X6", "X20"))
def q_ohlcv_bars_stream(spark, sf_dir):
    """Hourly bars from a stream that delivers every tick twice, 5-minute watermark (append mode), read back."""
    root = work_path(spark, "live-bars")
    # Every tick is delivered twice; re-deliveries are dropped within the watermark.
    twice = _events_stream(spark, sf_dir).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    ticks = event_ticks(twice)
    bars = live_bars(ticks, "1 hour", f"{STREAM_DELAY_MIN} minutes", dedupe_on=("instrument", "seq"))
    q = land(bars, f"{root}/data", f"{root}/checkpoint", partition_by=(), available_now=True)
    q.awaitTermination()
    return spark.read.schema(bars.schema).parquet(f"{root}/data")


_EVENTS_SQL = f"SELECT {_EVENTS_COLS} FROM events"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@register("csv_roundtrip", sql=_EVENTS_SQL, ids=("K3", "S5", "X21"))
def q_csv_roundtrip(spark, sf_dir):
    """Events exported as CSV with a header and read back with an explicit schema."""
    ev = _events(spark, sf_dir)
    path = write_csv(ev, work_path(spark, "csv"))
    return read_csv(spark, path, ev.schema)


@register("json_roundtrip", sql=_EVENTS_SQL, ids=("K6",))
def q_json_roundtrip(spark, sf_dir):
    """Events appended as JSON lines in two appends, read back whole."""
    ev = _events(spark, sf_dir)
    path = work_path(spark, "jsonl")
    append_json_lines(ev.where(F.col("event_type") < "m"), path)
    append_json_lines(ev.where(~(F.col("event_type") < "m")), path)
    return read_json_lines(spark, path, ev.schema)


@register("table_append", sql=_EVENTS_SQL, ids=("K5", "U2"))
def q_table_append(spark, sf_dir):
    """Events appended to a named table in two appends, read back through the catalog."""
    ev = _events(spark, sf_dir)
    name = work_table(spark, "ticks")
    path = work_path(spark, "table")
    append_table(ev.where(F.col("event_type") < "m"), name, path)
    append_table(ev.where(~(F.col("event_type") < "m")), name, path)
    return spark.table(name)


@register("ping_log", sql="""
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, round(value, 2) AS latency,
       event_type AS sponsor, round(user_id * CAST(1.5 AS DOUBLE), 2) AS distance
FROM events
""", ids=("N1", "T9", "K4"))
def q_ping_log(spark, sf_dir):
    """Events as a network-probe log (stamp, latency, sponsor, distance) appended to a log table."""
    ev = _events(spark, sf_dir)
    rows = ev.select(stamp_text("ts").alias("timestamp"), F.round("value", 2).alias("latency"),
                     F.col("event_type").alias("sponsor"),
                     F.round(F.col("user_id") * 1.5, 2).alias("distance"))
    path = work_path(spark, "ping-log")
    for part in (F.col("sponsor") < "m", ~(F.col("sponsor") < "m")):  # the log grows by appends
        rows.where(part).write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _quarantined_sql():
    return REGISTRY["tick_quarantine"].sql


@register("tick_landing_quarantine", sql=f"""
SELECT event_id, ExchangeInstrumentID, LastTradedPrice, _reason,
       CASE WHEN _reason IS NULL THEN 'clean' ELSE 'quarantine' END AS status,
       strftime(make_timestamp((LastUpdateTime + 315532800) * 1000000), '%Y_%m_%d') AS ingest_date
FROM ({_quarantined_sql()})
""", ids=("D4", "X10", "W8", "S8", "S9"))
def q_tick_landing_quarantine(spark, sf_dir):
    """Stream of partly spoilt payloads landed in one pass; clean and quarantined rows read back, none lost."""
    msgs = _events_stream(spark, sf_dir).select("event_id", spoilt_feed1_text().alias("value"))
    landed = _land_feed1(spark, msgs, "value", work_path(spark, "landing-q"), status=None)
    return landed.select("event_id", "ExchangeInstrumentID", "LastTradedPrice", "_reason", "status", "ingest_date")


@register("landing_report", sql=f"""
SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE _reason = 'malformed') AS BIGINT) AS corrupt,
       CAST(count(_reason) AS BIGINT) AS quarantined
FROM ({_quarantined_sql()})
""", ids=("W6",))
def q_landing_report(spark, sf_dir):
    """Delivery report of a landing run: rows, corrupt and quarantined rows over its micro-batches."""
    root = work_path(spark, "landing-report")
    msgs = _events_stream(spark, sf_dir).select("event_id", spoilt_feed1_text().alias("value"))
    checked = decode_checked(msgs, "value", TICK_FEED1, required=FEED1_KEYS, keep=["event_id"])
    checked = observed(with_ingest_date(checked, from_epoch1980("LastUpdateTime")))
    q = land_checked(checked, f"{root}/data", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    batches = [p["observed"]["landing"] for p in progress_summary(q) if p["observed"]]  # a row per micro-batch
    report = spark.createDataFrame([(m["rows"], m["corrupt"], m["quarantined"]) for m in batches],
                                   "rows long, corrupt long, quarantined long")
    return report.agg(*[F.sum(c).alias(c) for c in report.columns])


_LANDED_MINUTE = "make_timestamp((epoch_us(ts) // 1000000 // 60) * 60000000)"


@register("landed_minute_bars", sql=f"""
SELECT 2 AS exchangeSegment, CAST(user_id AS INTEGER) AS exchangeInstrumentID, {_LANDED_MINUTE} AS bar_start,
       strftime({_LANDED_MINUTE} + INTERVAL 1 MINUTE, '%H:%M') AS Timestamp,
       first(value ORDER BY epoch_us(ts) // 1000000, event_id) AS Open, max(value) AS High, min(value) AS Low,
       last(value ORDER BY epoch_us(ts) // 1000000, event_id) AS Close, CAST(sum({SQL_EVENT_QTY}) AS BIGINT) AS Volume
FROM events WHERE ts IS NOT NULL GROUP BY user_id, 3
""", ids=("S3", "A1", "A2", "A3", "A4", "A5", "A6", "A7", "P5", "P13", "T1", "T4", "F6"))
def q_landed_minute_bars(spark, sf_dir):
    """The main batch job: landed feed-1 ticks of a range of days, one-minute bars per (segment, instrument)."""
    msgs = _events_stream(spark, sf_dir).select(
        "event_id", F.encode(to_json_text(*feed1_fields()), "UTF-8").alias("value"))
    landed = _land_feed1(spark, msgs, bytes_to_text("value"), work_path(spark, "landing-bars"))
    return landed_bars(landed.where(F.col("ingest_date").between(*ALL_DAYS)), "1 minute")


ALL_DAYS = ("1980_01_01", "2999_12_31")  # the job's day range: folders outside it are not read


def landed_bars(landed, width):
    """Bars of landed feed-1 ticks, with the exported column names and the bar-end label."""
    ticks = landed.select(F.col("ExchangeSegment").alias("exchangeSegment"),
                          F.col("ExchangeInstrumentID").alias("exchangeInstrumentID"),
                          from_epoch1980("LastUpdateTime").alias("ts"), F.col("LastTradedPrice").alias("price"),
                          F.col("LastTradedQunatity").alias("qty"), F.col("event_id").alias("seq"))
    bars = ohlcv(ticks, width, keys=("exchangeSegment", "exchangeInstrumentID"), label="HH:mm", label_side="end")
    return bars.select("exchangeSegment", "exchangeInstrumentID", "bar_start", F.col("bar_label").alias("Timestamp"),
                       F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
                       F.col("close").alias("Close"), F.col("volume").alias("Volume"))


def _compared_side(where: str, order: str) -> str:
    return f"""
SELECT CAST(user_id AS BIGINT) AS instrument, {sql_bucket('ts', 3600)} AS bar_start,
       first(value ORDER BY {order}, event_id) AS open, max(value) AS high, min(value) AS low,
       last(value ORDER BY {order}, event_id) AS close, CAST(sum({SQL_EVENT_QTY}) AS BIGINT) AS volume
FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN (event_id // 7) % 4 END AS kind FROM events)
WHERE ts IS NOT NULL {where} GROUP BY user_id, 2"""


def compare_sql(how: str) -> str:
    cols = ["instrument", "bar_start", "open", "high", "low", "close", "volume"]
    sides = ", ".join(f"{p}.{c} AS {c}{s}" for p, s in (("a", "_api"), ("b", "_s3")) for c in cols)
    status = """, CASE WHEN b.instrument IS NULL THEN 'api_only' WHEN a.instrument IS NULL THEN 'landed_only'
                WHEN a.volume IS NOT DISTINCT FROM b.volume THEN 'match' ELSE 'differ' END AS status""" \
        if how != "INNER" else ""
    return f"""
SELECT {sides}, a.volume - b.volume AS Volume_Difference{status}
FROM ({_compared_side("", "ts")}) a {how} JOIN ({_compared_side("AND kind IS NULL", "epoch_us(ts) // 1000000")}) b
  ON a.instrument = b.instrument AND a.bar_start = b.bar_start"""


BARS_CSV = ("instrument bigint, bar_start timestamp_ntz, open double, high double, low double, close double, "
            "volume bigint")


def broker_and_landed_bars(spark, sf_dir, root):
    """Hourly bars decoded from broker responses, and hourly bars of landed ticks, by side.

    The landed side lacks the ticks that landing quarantined; both sides are whole.
    """
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.col("user_id").alias("instrument"), "ts", F.col("value").alias("price"),
                      event_k().alias("qty"), F.col("event_id").alias("seq"))
    responses = encode_broker_responses(ohlcv(ticks, "1 hour"))
    broker = decode_broker_bars(responses, "response", 2, "instrument").withColumnRenamed("bar_time", "bar_start")
    msgs = _events_stream(spark, sf_dir).select("event_id", spoilt_feed1_text().alias("value"))
    landed = landed_bars(_land_feed1(spark, msgs, "value", f"{root}/landing"), "1 hour")
    return {name: bars.select(F.col("exchangeInstrumentID").cast("bigint").alias("instrument"), "bar_start",
                              F.col("Open").alias("open"), F.col("High").alias("high"), F.col("Low").alias("low"),
                              F.col("Close").alias("close"), F.col("Volume").cast("bigint").alias("volume"))
            for name, bars in (("api", broker), ("s3", landed))}


def compare_broker_with_landed(spark, sf_dir, how):
    """Broker responses against landed ticks: each side's hourly bars exported as CSV, read back and joined."""
    root = work_path(spark, "compare")
    sides = [read_bar_csv(spark, write_csv(bars, f"{root}/{name}"), BARS_CSV)
             for name, bars in broker_and_landed_bars(spark, sf_dir, root).items()]
    return reconcile_volume(*sides, how=how)


@register("broker_vs_landed", sql=compare_sql("INNER"), ids=("J1", "P6", "P12", "N2", "K3", "S5", "X13"))
def q_broker_vs_landed(spark, sf_dir):
    """Decoded broker bars against landed bars through two CSV exports: bars seen by both, with the volume gap."""
    return compare_broker_with_landed(spark, sf_dir, "inner")


@register("broker_vs_landed_full", sql=compare_sql("FULL OUTER"), ids=("J2", "X12"))
def q_broker_vs_landed_full(spark, sf_dir):
    """The same comparison keeping bars seen by one side only, with a status column."""
    return compare_broker_with_landed(spark, sf_dir, "full_outer")


@register("feed2_landing_stream", sql="SELECT *, strftime(exchange_ts, '%Y_%m_%d') AS ingest_date FROM ("
          + REGISTRY["tick_list_prune"].sql + ")", ids=("P4", "M3", "T10", "X24", "K1", "K7"))
def q_feed2_landing_stream(spark, sf_dir):
    """Feed-2 callback lists landed by a stream: every tick, nested parts dropped, text times parsed, by tick day."""
    root = work_path(spark, "feed2")
    lists = feed2_tick_lists(table(spark, sf_dir, "events"))
    lists.write.parquet(f"{root}/bus")
    stream = file_stream(spark, f"{root}/bus", lists.schema)
    ticks = prune_tick(explode_ticks_checked(stream, "value", TICK_FEED2_RAW, required=["instrument_token"],
                                             keep=["list_id"]))
    ticks = ticks.withColumn("exchange_ts", text_to_time("exchange_timestamp"))
    ticks = with_ingest_date(ticks, "exchange_ts")
    q = land_checked(ticks, f"{root}/data", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    landed = read_landed(spark, f"{root}/data", schema=with_status(ticks).schema).where(F.col("status") == "clean")
    return landed.select("list_id", "pos", *[f.name for f in TICK_FEED2.fields], "has_depth", "exchange_ts",
                         "ingest_date")


@register("candle_landing_stream", sql="SELECT segment, instrument, bt, o, h, l, c, bv, pv, "
          "strftime(bt, '%Y_%m_%d') AS ingest_date FROM (" + REGISTRY["candle_decode"].sql + ")",
          ids=("X6", "X7", "P14", "K1", "W5"))
def q_candle_landing_stream(spark, sf_dir):
    """Vendor candles (JSON-encoded twice) landed by a stream: unwrapped, decoded, key split, by bar day."""
    root = work_path(spark, "candles")
    msgs = candle_messages(spark, sf_dir)
    msgs.write.parquet(f"{root}/bus")
    stream = file_stream(spark, f"{root}/bus", msgs.schema)
    checked = decode_checked(stream, bytes_to_text("value"), CANDLE, required=["t", "bt"], unwrap=True)
    checked = with_ingest_date(checked, "bt")
    q = land_checked(checked, f"{root}/data", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    landed = read_landed(spark, f"{root}/data", schema=with_status(checked).schema).where(F.col("status") == "clean")
    return landed.withColumn("k", split_compound_key("t")).select(
        "k.segment", "k.instrument", F.col("bt").cast("timestamp_ntz").alias("bt"), "o", "h", "l", "c", "bv", "pv",
        "ingest_date")


@register("bars_correction", sql=f"""
SELECT *, strftime(bar_start, '%Y_%m_%d') AS ingest_date FROM ({_event_bar_sql(3600)})
""", ids=("W5", "X14", "K1", "S3"))
def q_bars_correction(spark, sf_dir):
    """Late ticks (every 5th id, on even days of the month): first bars miss them, a correction run over
    the landed table rebuilds the touched days and leaves the odd days as they are; result read back."""
    root = work_path(spark, "correction")
    ev = table(spark, sf_dir, "events")
    late = F.coalesce((F.col("event_id") % 5 == 0) & (F.dayofmonth("ts") % 2 == 0), F.lit(False))
    landed_path, bars_path = f"{root}/landed", f"{root}/bars"
    # First pass: on-time ticks landed and barred.
    cluster = lambda d: cluster_for_partitioned_write(d, ["ingest_date"], ["ts"])
    cluster(with_ingest_date(ev.where(~late), "ts")).write.partitionBy("ingest_date").parquet(landed_path)
    write_bars(bars_by_day(event_ticks(spark.read.parquet(landed_path)), "1 hour"), bars_path, dynamic=False)
    # Late ticks land afterwards; bars of the days they touch are rebuilt.
    late_rows = with_ingest_date(ev.where(late), "ts")
    cluster(late_rows).write.mode("append").partitionBy("ingest_date").parquet(landed_path)
    correct_bars(spark, landed_path, bars_path, touched_days(ev.where(late), "1 hour"), "1 hour",
                 ticks_view=event_ticks)
    return spark.read.parquet(bars_path)


@register("topic_landing_stream", sql="""
SELECT event_id, MessageCode, 'message' || CAST(MessageCode AS VARCHAR) || '_json_full' AS topic,
       strftime(ts, '%Y_%m_%d') AS ingest_date
FROM (SELECT event_id, ts, CASE event_type WHEN 'click' THEN 1501 WHEN 'view' THEN 1502
             WHEN 'signup' THEN 1505 WHEN 'error' THEN 1507 WHEN 'purchase' THEN 1512 END AS MessageCode
      FROM events)
""", ids=("F5", "W8", "K1", "K7"))
def q_topic_landing_stream(spark, sf_dir):
    """Every message kind routed and landed by one streaming job, partitioned by topic and day."""
    from tickweave.operators.routing import route
    from tickweave.plans.order_queries import _kind_col

    root = work_path(spark, "topics")
    ev = _events_stream(spark, sf_dir).select("event_id", "ts", _kind_col().alias("MessageCode"))
    routed = with_ingest_date(route(ev, mode="full"), "ts").drop("ts")
    q = land(routed, f"{root}/data", f"{root}/checkpoint", partition_by=("topic", "ingest_date"),
             available_now=True)
    q.awaitTermination()
    return spark.read.schema(routed.schema).parquet(f"{root}/data")
