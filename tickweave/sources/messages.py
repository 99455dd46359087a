"""Bus payloads derived from the driver tables (what the producers would send).

Each function turns table rows into the text a feed puts on the bus, so the
decode side can be exercised on the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.timeutil import stamp_text, to_epoch1980
from tickweave.operators.decode import to_json_text

def event_k() -> Column:
    """The quantity carried in ``events.props`` (``{"k": n}``)."""
    return F.get_json_object("props", "$.k").try_cast("int")


def feed1_fields(**override) -> list[Column]:
    """Feed-1 (kind 1512) fields from an events row; instrument = user.

    ``override`` replaces a field's value expression by name (used to spoil payloads).
    """
    fields = [
        ("MessageCode", F.lit(1512)), ("MessageVersion", F.lit(4)),
        ("ApplicationType", F.lit(0)), ("TokenID", F.lit(0)),
        ("ExchangeSegment", F.lit(2)),
        ("ExchangeInstrumentID", F.col("user_id").cast("int")),
        ("BookType", F.lit(1)), ("XMarketType", F.lit(1)),
        ("LastTradedPrice", F.col("value")),
        ("LastTradedQunatity", event_k()),
        ("LastUpdateTime", to_epoch1980("ts")),
    ]
    return [override.get(n, e).alias(n) for n, e in fields]


def feed1_messages(events: DataFrame) -> DataFrame:
    """(event_id, value bytes) as a Kafka record of feed 1 would carry."""
    return events.select("event_id", F.encode(to_json_text(*feed1_fields()), "UTF-8").alias("value"))


def python_string(c: Column) -> Column:
    """A text as Python's ``repr`` writes it (printable characters, blanks and the bell)."""
    double = c.contains("'") & ~c.contains('"')
    body = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\x07", "\\x07")):
        body = F.replace(body, F.lit(raw), F.lit(escape))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(single)


def python_repr_messages(events: DataFrame, note: Column | None = None) -> DataFrame:
    """Payload written as Python ``str(dict)``: quoted strings, None/True/False.

    ``note``: the literal text of the note field (default: ``'u<user>'`` or None).
    """
    k = F.coalesce(event_k().cast("string"), F.lit("None"))
    big = F.when(F.col("value") > 100, F.lit("True")).otherwise(F.lit("False"))
    if note is None:
        note = F.when(F.col("user_id") % 3 == 0, F.lit("None")).otherwise(
            python_string(F.concat(F.lit("u"), F.col("user_id").cast("string"))))
    text = F.concat(
        F.lit("{'event_id': "), F.col("event_id").cast("string"),
        F.lit(", 'event_type': "), python_string(F.col("event_type")),
        F.lit(", 'value': "), F.col("value").cast("string"),
        F.lit(", 'k': "), k, F.lit(", 'big': "), big, F.lit(", 'note': "), note, F.lit("}"))
    return events.select("event_id", text.alias("value"))


def feed2_tick(depth_types=("purchase", "click")) -> Column:
    """A feed-2 tick struct; ticks of ``depth_types`` come in full mode with depth."""
    full = F.col("event_type").isin(*depth_types)
    k = event_k().cast("long")
    level = F.struct(k.alias("quantity"), F.col("value").alias("price"), F.lit(1).cast("long").alias("orders"))
    return F.struct(
        F.lit(True).alias("tradable"),
        F.when(full, F.lit("full")).otherwise(F.lit("quote")).alias("mode"),
        F.col("user_id").alias("instrument_token"),
        F.col("value").alias("last_price"),
        event_k().alias("last_traded_quantity"),
        F.col("value").alias("average_traded_price"),
        F.col("event_id").alias("volume_traded"),
        (k * 2).alias("total_buy_quantity"),
        (k * 3).alias("total_sell_quantity"),
        F.when(full, F.struct(*[F.col("value").alias(n) for n in ("open", "high", "low", "close")])).alias("ohlc"),
        F.lit(0.0).alias("change"),
        stamp_text("ts").alias("last_trade_time"),
        stamp_text("ts").alias("exchange_timestamp"),
        F.when(full, F.struct(F.array(level).alias("buy"), F.array(level).alias("sell"))).alias("depth"),
    )


def feed2_tick_lists(events: DataFrame, per_list: int = 4) -> DataFrame:
    """(list_id, value) where value is a JSON array of up to ``per_list`` ticks.

    Lists are runs of consecutive event ids, so every group is bounded by
    ``per_list`` however the data is skewed.
    """
    lst = F.expr(f"event_id div {int(per_list)}")
    return (events.groupBy(lst.alias("list_id"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col("event_id"), feed2_tick().alias("t")))).alias("a"))
            .select("list_id", F.to_json(F.transform("a", lambda x: x["t"])).alias("value")))


def master_lines(part: DataFrame, keep=()) -> DataFrame:
    """Instrument-master dump rows built from ``part`` (one pipe-joined line per part).

    symbol (Name) = p_type, series = p_brand, strike = p_size; PROMO parts play
    futures: their series gets a ``FUT`` prefix and the line lacks strike and
    option type (two fields short), as the service sends futures rows.
    """
    fut = F.col("p_type") == "PROMO"
    series = F.when(fut, F.concat(F.lit("FUT"), F.col("p_brand"))).otherwise(F.col("p_brand"))
    segment = F.when(F.col("p_type").isin("PROMO", "LARGE", "MEDIUM"), F.lit("NSEFO")).otherwise(F.lit("NSECM"))
    expiry = (F.when(F.col("p_partkey") % 3 == 0, F.lit("2024-01-25"))
              .when(F.col("p_partkey") % 3 == 1, F.lit("2024-02-29")).otherwise(F.lit("2024-03-28")))
    s = lambda c: F.col(c).cast("string")
    head = [segment, s("p_partkey"), F.when(fut, F.lit("1")).otherwise(F.lit("2")), F.col("p_type"),
            F.col("p_name"), series, F.concat_ws("-", F.col("p_type"), series),
            (F.col("p_partkey") + 1000000).cast("string"),
            (F.col("p_retailprice") + 10).cast("string"), (F.col("p_retailprice") - 10).cast("string"),
            (F.col("p_size") * 100).cast("string"), F.lit("0.05"), s("p_size"), F.lit("1"), F.lit("-1"),
            F.upper(F.get(F.split(F.col("p_name"), " "), 0)), expiry]
    strike_opt = [s("p_size"), F.when(F.col("p_partkey") % 2 == 0, F.lit("3")).otherwise(F.lit("4"))]
    tail = [F.concat_ws(" ", F.col("p_name"), s("p_size")), F.lit("1"), F.lit("1"),
            F.concat_ws(" ", F.col("p_name"), F.col("p_brand"))]
    line = F.when(fut, F.concat_ws("|", *head, *tail)).otherwise(F.concat_ws("|", *head, *strike_opt, *tail))
    return part.select(*keep, line.alias("value"))
