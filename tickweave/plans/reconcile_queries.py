"""Broker bars, reconciliation, profiling and instrument-master (reference data) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.operators import instruments as I
from tickweave.operators.bars import ohlcv
from tickweave.operators.broker import decode_broker_bars, decode_broker_bars_checked, encode_broker_responses
from tickweave.operators.reconcile import column_profile, reconcile_subset
from tickweave.operators.routing import request_table
from tickweave.plans.catalog import SQL_EVENT_QTY, register, sql_bucket
from tickweave.session import is_kept, source_version, work_path
from tickweave.sources.files import read_master_dump
from tickweave.sinks.files import write_text
from tickweave.sources.messages import event_k, master_lines
from tickweave.sources.tables import lineitem_ticks, table

# ---- broker bars -------------------------------------------------------------


@register("broker_bars_decode", sql=f"""
SELECT 2 AS exchangeSegment, CAST(user_id AS BIGINT) AS exchangeInstrumentID,
       {sql_bucket('ts', 3600)} AS bar_time,
       strftime({sql_bucket('ts', 3600)}, '%H:%M') AS Timestamp,
       first(value ORDER BY ts, event_id) AS Open, max(value) AS High, min(value) AS Low,
       last(value ORDER BY ts, event_id) AS Close,
       CAST(sum({SQL_EVENT_QTY}) AS BIGINT) AS Volume, CAST(0 AS BIGINT) AS OI
FROM events
WHERE ts IS NOT NULL
GROUP BY user_id, 3
""", ids=("S7", "P10", "P11", "F2", "C3", "C4", "N3", "T5", "M1", "X22"))
def q_broker_bars_decode(spark, sf_dir):
    """Hourly bars per user sent as broker responses (one per user-day), decoded back."""
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.col("user_id").alias("instrument"), "ts", F.col("value").alias("price"),
                      F.get_json_object("props", "$.k").try_cast("int").alias("qty"),
                      F.col("event_id").alias("seq"))
    responses = encode_broker_responses(ohlcv(ticks, "1 hour"))
    return decode_broker_bars(responses, "response", 2, "instrument")


# ---- reconciliation ------------------------------------------------------------

def _reconciled_days(spark, sf_dir, how):
    """Daily bars of all traded lines (broker side) against those of the lines whose order is filled (landed side)."""
    li, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    filled = orders.where(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey").distinct().withColumn("filled", F.lit(True))
    lines = li.join(filled, li.l_orderkey == filled.o_orderkey, "left")
    ticks = lineitem_ticks(lines, "filled")
    return reconcile_subset(ticks, F.col("filled").isNotNull(), "1 day", how=how)


_SIDE = """
SELECT l_partkey AS instrument,
       {b} AS bar_start, {b} + INTERVAL 1 DAY AS bar_end,
       first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS open,
       max(l_extendedprice) AS high, min(l_extendedprice) AS low,
       last(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS close,
       sum(l_quantity) AS volume, count(*) AS ticks
FROM lineitem WHERE l_shipdate IS NOT NULL {w}
GROUP BY 1, 2
""".replace("{b}", sql_bucket("l_shipdate", 86400))

_SUFFIXED = "{p}.instrument AS instrument{s}, {p}.bar_start AS bar_start{s}, {p}.bar_end AS bar_end{s}, " \
            "{p}.open AS open{s}, {p}.high AS high{s}, {p}.low AS low{s}, {p}.close AS close{s}, " \
            "{p}.volume AS volume{s}, {p}.ticks AS ticks{s}"


def _reconcile_sql(how: str) -> str:
    status = """,
       CASE WHEN a.instrument IS NOT NULL AND b.instrument IS NULL THEN 'api_only'
            WHEN a.instrument IS NULL AND b.instrument IS NOT NULL THEN 'landed_only'
            WHEN abs(a.volume - b.volume) <= 0.0 THEN 'match' ELSE 'differ' END AS status""" \
        if how != "INNER" else ""
    return f"""
SELECT {_SUFFIXED.format(p='a', s='_api')}, {_SUFFIXED.format(p='b', s='_s3')},
       a.volume - b.volume AS Volume_Difference{status}
FROM ({_SIDE.replace('{w}', '')}) a
{how} JOIN ({_SIDE.replace('{w}', "AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P'))")}) b
  ON a.instrument = b.instrument AND a.bar_start = b.bar_start
"""


@register("volume_reconcile", sql=_reconcile_sql("INNER"), ids=("P6", "J1", "P12", "N2"))
def q_volume_reconcile(spark, sf_dir):
    """Daily bars of all lines (broker side) vs lines of filled orders (landed side): matched bars and volume gap."""
    return _reconciled_days(spark, sf_dir, "inner")


@register("volume_reconcile_full", sql=_reconcile_sql("FULL OUTER"), ids=("J2", "X12"))
def q_volume_reconcile_full(spark, sf_dir):
    """The same comparison keeping bars seen by one side only, with a status column."""
    return _reconciled_days(spark, sf_dir, "full_outer")


_PROFILE_COLS = [(f"{c}{s}", t) for s in ("_api", "_s3") for c, t in (
    ("instrument", "bigint"), ("bar_start", "timestamp_ntz"), ("bar_end", "timestamp_ntz"),
    ("open", "double"), ("high", "double"), ("low", "double"), ("close", "double"),
    ("volume", "double"), ("ticks", "bigint"))] + [("Volume_Difference", "double"), ("status", "string")]


@register("column_profile", sql="WITH r AS (" + _reconcile_sql("FULL OUTER") + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null, count(*) AS rows FROM r"
    for c, t in _PROFILE_COLS), ids=("A8", "A9"))
def q_column_profile(spark, sf_dir):
    """Name, type and non-NULL count of every column of the full reconciliation."""
    return column_profile(_reconciled_days(spark, sf_dir, "full_outer"))


@register("broker_bars_checked", sql=f"""
WITH b AS (
  SELECT CAST(user_id AS BIGINT) AS id, {sql_bucket('ts', 3600)} AS bar_time,
         CAST(sum({SQL_EVENT_QTY}) AS BIGINT) AS Volume FROM events WHERE ts IS NOT NULL GROUP BY user_id, 2)
SELECT id AS exchangeInstrumentID, bar_time, Volume, CAST(NULL AS VARCHAR) AS _reason FROM b WHERE id % 5 <> 0
UNION ALL
SELECT id, CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT), 'no_data'
FROM (SELECT DISTINCT id, CAST(bar_time AS DATE) FROM b WHERE id % 5 = 0)
UNION ALL
SELECT id, CAST(NULL AS TIMESTAMP), CAST(5 AS BIGINT), 'bad_time'
FROM (SELECT DISTINCT id, CAST(bar_time AS DATE) FROM b WHERE id % 5 = 1)
""", ids=("S7", "F2", "N3", "X10", "D4"))
def q_broker_bars_checked(spark, sf_dir):
    """Partly spoilt broker responses: clean bars, and a row with a reason for each that does not decode."""
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.col("user_id").alias("instrument"), "ts", F.col("value").alias("price"),
                      event_k().alias("qty"), F.col("event_id").alias("seq"))
    responses = encode_broker_responses(ohlcv(ticks, "1 hour"))
    kind = F.col("instrument") % 5  # 0: cut off; 1: one more row without a time
    spoilt = responses.withColumn("response", F.when(kind == 0, F.substring("response", 1, 30)).when(
        kind == 1, F.regexp_replace("response", r'("dataReponse":")', "$1noon|1|2|3|4|5|0|,")).otherwise(F.col("response")))
    out = decode_broker_bars_checked(spoilt, "response", 2, "instrument")
    return out.select("exchangeInstrumentID", "bar_time", "Volume", "_reason")


# ---- instrument master -----------------------------------------------------------

def _fields_sql() -> str:
    fut = "p_type = 'PROMO'"
    series = f"CASE WHEN {fut} THEN 'FUT' || p_brand ELSE p_brand END"
    return f"""
SELECT CASE WHEN p_type IN ('PROMO', 'LARGE', 'MEDIUM') THEN 'NSEFO' ELSE 'NSECM' END AS ExchangeSegment,
       CAST(p_partkey AS VARCHAR) AS ExchangeInstrumentID,
       CASE WHEN {fut} THEN '1' ELSE '2' END AS InstrumentType,
       p_type AS Name, p_name AS Description, {series} AS Series,
       p_type || '-' || {series} AS NameWithSeries,
       CAST(p_partkey + 1000000 AS VARCHAR) AS InstrumentID,
       CAST(p_retailprice + 10 AS VARCHAR) AS PriceBandHigh,
       CAST(p_retailprice - 10 AS VARCHAR) AS PriceBandLow,
       CAST(p_size * 100 AS VARCHAR) AS FreezeQty, '0.05' AS TickSize,
       CAST(p_size AS VARCHAR) AS LotSize, '1' AS Multiplier, '-1' AS UnderlyingInstrumentId,
       upper(split_part(p_name, ' ', 1)) AS UnderlyingIndexName,
       CASE p_partkey % 3 WHEN 0 THEN '2024-01-25' WHEN 1 THEN '2024-02-29' ELSE '2024-03-28' END
         AS ContractExpiration,
       CASE WHEN {fut} THEN NULL ELSE CAST(p_size AS VARCHAR) END AS StrikePrice,
       CASE WHEN {fut} THEN NULL WHEN p_partkey % 2 = 0 THEN '3' ELSE '4' END AS OptionType,
       p_name || ' ' || CAST(p_size AS VARCHAR) AS DisplayName,
       '1' AS PriceNumerator, '1' AS PriceDenominator,
       p_name || ' ' || p_brand AS DetailedDescription
FROM part
"""


MASTER_SQL = _fields_sql()


_LANDED: dict[tuple, str] = {}


def _master(spark, sf_dir):
    """The repaired master landed by segment, as look-ups read it: they prune folders and push filters into the scan.

    Landed once for a session and version of its source, as long as the work folder is kept.
    """
    part = f"{sf_dir.rstrip('/')}/part.parquet"
    key = (spark.sparkContext.applicationId, part, source_version(spark, part))
    if not is_kept(_LANDED.get(key, "")):
        master = I.repair_futures(I.parse_master_lines(master_lines(table(spark, sf_dir, "part"))))
        _LANDED[key] = I.land_master(master, work_path(spark, "master"))
    return I.read_master(spark, _LANDED[key])


@register("master_dump_split", sql=MASTER_SQL, ids=("C1", "C2", "P9"))
def q_master_dump_split(spark, sf_dir):
    """Master dumps held as one text of many lines (here a dump per 50 instruments), trimmed and split on newlines."""
    part = table(spark, sf_dir, "part")
    lines = master_lines(part.select("*", F.expr("p_partkey div 50").alias("dump")), keep=["dump"])
    dumps = lines.groupBy("dump").agg(F.concat(F.lit("\n"), F.array_join(F.collect_list("value"), "\n"),
                                               F.lit("\n\n")).alias("value"))
    return I.repair_futures(I.parse_master_lines(I.split_dump(dumps)))


@register("instrument_master", sql=MASTER_SQL, ids=("S6", "P9", "C5", "M6", "W7", "X23"))
def q_instrument_master(spark, sf_dir):
    """Master dump written as ragged pipe text to the shared folder, read back, futures repaired."""
    path = work_path(spark, "master-dump")
    write_text(master_lines(table(spark, sf_dir, "part")), path)
    return I.repair_futures(read_master_dump(spark, path))


# Fixed request parameters of the look-ups (the service's arguments).
ISIN_IDS = [35, 150, 1999, 777, 12345]


@register("instrument_isin", sql=f"""
SELECT * FROM ({MASTER_SQL}) WHERE ExchangeInstrumentID IN ({", ".join(f"'{i}'" for i in ISIN_IDS)})
""", ids=("F1",))
def q_instrument_isin(spark, sf_dir):
    """Keep a list of instrument ids (the operator's own parameter)."""
    return I.keep_instruments(_master(spark, sf_dir), ISIN_IDS)


@register("instrument_series", sql=f"""
SELECT DISTINCT Series FROM ({MASTER_SQL}) WHERE ExchangeSegment = 'NSEFO'
""", ids=("L1",))
def q_instrument_series(spark, sf_dir):
    """Series listed in a segment."""
    return I.series_of(_master(spark, sf_dir), "NSEFO")


@register("instrument_equity", sql=f"""
SELECT * FROM ({MASTER_SQL}) WHERE ExchangeSegment = 'NSECM' AND Series = 'Brand#12' AND Name = 'ECONOMY'
""", ids=("L2",))
def q_instrument_equity(spark, sf_dir):
    """Equity look-up by segment, series and symbol."""
    return I.equity(_master(spark, sf_dir), "NSECM", "Brand#12", "ECONOMY")


@register("instrument_expiry", sql=f"""
SELECT DISTINCT ContractExpiration FROM ({MASTER_SQL})
WHERE ExchangeSegment = 'NSEFO' AND Series = 'FUTBrand#12' AND Name = 'PROMO' AND ContractExpiration IS NOT NULL
""", ids=("L3",))
def q_instrument_expiry(spark, sf_dir):
    """Contract expiry dates of a symbol, sorted."""
    return I.expiry_dates(_master(spark, sf_dir), "NSEFO", "FUTBrand#12", "PROMO")


@register("instrument_future", sql=f"""
SELECT * FROM ({MASTER_SQL})
WHERE ExchangeSegment = 'NSEFO' AND Series = 'FUTBrand#12' AND Name = 'PROMO' AND ContractExpiration = '2024-02-29'
""", ids=("L4",))
def q_instrument_future(spark, sf_dir):
    """Future look-up by segment, series, symbol and expiry."""
    return I.future(_master(spark, sf_dir), "NSEFO", "FUTBrand#12", "PROMO", "2024-02-29")


@register("instrument_option", sql=f"""
SELECT * FROM ({MASTER_SQL})
WHERE ExchangeSegment = 'NSEFO' AND Series = 'Brand#16' AND Name = 'LARGE' AND ContractExpiration = '2024-01-25'
  AND OptionType = '3' AND StrikePrice = '3'
""", ids=("L5",))
def q_instrument_option(spark, sf_dir):
    """Option look-up by expiry, option type and strike."""
    return I.option(_master(spark, sf_dir), "NSEFO", "Brand#16", "LARGE", "2024-01-25", "3", "3")


@register("instrument_option_types", sql=f"""
SELECT DISTINCT OptionType FROM ({MASTER_SQL})
WHERE ExchangeSegment = 'NSEFO' AND Series = 'Brand#16' AND Name = 'LARGE' AND ContractExpiration = '2024-01-25'
  AND OptionType IS NOT NULL
""", ids=("L6",))
def q_instrument_option_types(spark, sf_dir):
    """Option types listed for a symbol and expiry."""
    return I.option_types(_master(spark, sf_dir), "NSEFO", "Brand#16", "LARGE", "2024-01-25")


@register("instrument_index_list", sql=f"""
SELECT DISTINCT UnderlyingIndexName FROM ({MASTER_SQL})
WHERE ExchangeSegment = 'NSEFO' AND UnderlyingIndexName IS NOT NULL
""", ids=("L7",))
def q_instrument_index_list(spark, sf_dir):
    """Underlying index names of a segment."""
    return I.index_list(_master(spark, sf_dir), "NSEFO")


SEARCH_PAIRS = [("NSEFO", "35"), ("NSECM", "36"), ("NSEFO", "150"), ("NSECM", "999"), ("NSEFO", "1234")]


@register("instrument_search_ids", sql=f"""
SELECT m.* FROM ({MASTER_SQL}) m
WHERE (m.ExchangeSegment, m.ExchangeInstrumentID) IN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in SEARCH_PAIRS)})
""", ids=("L8",))
def q_instrument_search_ids(spark, sf_dir):
    """Search by a list of (segment, instrument id) pairs (broadcast semi-join)."""
    pairs = request_table(spark, SEARCH_PAIRS, "ExchangeSegment string, ExchangeInstrumentID string")
    return I.search_by_ids(_master(spark, sf_dir), pairs)


@register("instrument_search_text", sql=f"""
SELECT * FROM ({MASTER_SQL}) WHERE lower(Name) LIKE '%gizmo%' OR lower(DisplayName) LIKE '%gizmo%'
""", ids=("L9",))
def q_instrument_search_text(spark, sf_dir):
    """Case-insensitive text search on symbol or display name."""
    return I.search_text(_master(spark, sf_dir), "GIZMO")


@register("instrument_multi_segment", sql=f"""
SELECT * FROM ({MASTER_SQL}) WHERE ExchangeSegment IN ('NSECM', 'NSEFO')
""", ids=("L10",))
def q_instrument_multi_segment(spark, sf_dir):
    """Master rows of several segments."""
    return I.segments(_master(spark, sf_dir), ["NSECM", "NSEFO"])
