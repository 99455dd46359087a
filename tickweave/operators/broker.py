"""Broker bar responses: JSON envelope with delimited bar text, decoded into a bar table.

A response holds ``result.dataReponse`` (sic, the service's key): rows joined
by ``,``, fields by ``|``: ``Timestamp(Unix s)|Open|High|Low|Close|Volume|OI``,
with trailing delimiters. Decoding is one ``explode`` of the split rows plus
positional casts, all on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.text import positional_fields, strip_trailing
from tickweave.functions.timeutil import clock_label, from_unix_seconds
from tickweave.operators.decode import REASON

RESPONSE_PATH = "$.result.dataReponse"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_broker_bars_checked(df: DataFrame, response, segment, instrument, keep=(),
                               drop_empty_fields: bool = False, label: str = "HH:mm") -> DataFrame:
    """One row per bar of each response, and one per response without any; ``_reason`` says what is wrong.

    segment / instrument -- request keys attached to every row (literal or column; ids are longs)
    drop_empty_fields    -- old rule: remove empty fields before naming (shifts fields left)
    ``_reason``: ``no_data`` (not JSON, or without bar text), ``bad_key`` (instrument id is no
    integer), ``bad_time``, ``bad_number`` (a field that is there and is no number), else NULL.
    """
    text = strip_trailing(F.get_json_object(_c(response), RESPONSE_PATH), ",")
    rows = F.filter(F.split(text, ","), lambda r: r != F.lit(""))
    seg = segment if isinstance(segment, Column) else F.lit(segment)
    exploded = df.select(*keep, seg.alias("exchangeSegment"),
                         _c(instrument).try_cast("bigint").alias("exchangeInstrumentID"),
                         F.explode_outer(rows).alias("__row"))
    f = positional_fields(F.col("__row"), 7, drop_empty=drop_empty_fields)
    secs = F.get(f, 0).try_cast("long")
    numbers = [(n, F.get(f, i), t) for i, (n, t) in enumerate(
        [("Open", "double"), ("High", "double"), ("Low", "double"), ("Close", "double"), ("Volume", "long"),
         ("OI", "long")], 1)]
    bad_number = F.lit(False)
    for _, text_field, kind in numbers:
        there = F.coalesce(F.trim(text_field) != "", F.lit(False))
        bad_number = bad_number | (there & text_field.try_cast(kind).isNull())
    reason = (F.when(F.col("__row").isNull(), F.lit("no_data"))
              .when(F.col("exchangeInstrumentID").isNull(), F.lit("bad_key"))
              .when(secs.isNull(), F.lit("bad_time")).when(bad_number, F.lit("bad_number")))
    return exploded.select(
        *keep, "exchangeSegment", "exchangeInstrumentID",
        from_unix_seconds(secs).alias("bar_time"),
        clock_label(from_unix_seconds(secs), label).alias("Timestamp"),
        *[c.try_cast(kind).alias(n) for n, c, kind in numbers], reason.alias(REASON))


def decode_broker_bars(df: DataFrame, response, segment, instrument, **options) -> DataFrame:
    """The clean bars of :func:`decode_broker_bars_checked`."""
    checked = decode_broker_bars_checked(df, response, segment, instrument, **options)
    return checked.where(F.col(REASON).isNull()).drop(REASON)


def encode_broker_responses(bars: DataFrame, keys=("instrument",), oi: Column | None = None) -> DataFrame:
    """The inverse, as the service sends it: one response per (keys, UTC day).

    A response covers one instrument-day, so its size is bounded by the bars
    in a day whatever the skew across instruments.
    """
    row = F.concat_ws("|", F.unix_seconds(F.col("bar_start").cast("timestamp")).cast("string"),
                      *[F.col(c).cast("string") for c in ("open", "high", "low", "close")],
                      F.col("volume").cast("long").cast("string"),
                      (oi if oi is not None else F.lit(0)).cast("string"), F.lit(""))
    day = F.to_date("bar_start").alias("day")
    grouped = (bars.groupBy(*keys, day)
               .agg(F.array_sort(F.collect_list(F.struct(F.col("bar_start"), row.alias("r")))).alias("a")))
    text = F.concat(F.array_join(F.transform("a", lambda x: x["r"]), ","), F.lit(","))
    envelope = F.to_json(F.struct(F.lit("success").alias("type"),
                                  F.struct(text.alias("dataReponse")).alias("result")))
    return grouped.select(*keys, "day", envelope.alias("response"))
