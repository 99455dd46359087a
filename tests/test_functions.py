import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tickweave.functions import text as T
from tickweave.functions import timeutil as TU
from tickweave.operators.bars import ohlcv


def test_time_conversions(spark):
    df = spark.createDataFrame([(0,), (1_407_000_000,)], "s long")
    r = df.select(TU.from_epoch1980("s").alias("t"), TU.from_unix_seconds("s").alias("u")).collect()
    assert r[0].t == dt.datetime(1980, 1, 1) and r[0].u == dt.datetime(1970, 1, 1)
    back = df.select(TU.to_epoch1980(TU.from_epoch1980("s")).alias("b")).collect()
    assert [x.b for x in back] == [0, 1_407_000_000]
    t = spark.createDataFrame([(dt.datetime(2024, 8, 8, 9, 15, 42),)], "ts timestamp_ntz")
    row = t.select(TU.day_tag("ts").alias("d"), TU.clock_label(TU.truncate_minute("ts"), "HH:mm:ss").alias("c"),
                   TU.parse_request_time(F.lit("Aug 8 2024 091500")).alias("p"),
                   TU.stamp_text("ts").alias("s"), TU.text_to_time(F.lit("bad")).alias("x")).first()
    assert (row.d, row.c, row.p, row.s, row.x) == ("2024_08_08", "09:15:00", dt.datetime(2024, 8, 8, 9, 15),
                                                  "2024-08-08 09:15:42", None)


def test_text_helpers(spark):
    df = spark.createDataFrame([("2_35089", "10|101.5|3", "a|b||d|"), ("x_y", "1|2", None)], "t string, ai string, r string")
    rows = df.select(T.split_compound_key("t").alias("k"), T.split_depth("ai").alias("d"),
                     T.positional_fields(F.col("r"), 7).alias("p"),
                     T.positional_fields(F.col("r"), 7, drop_empty=True).alias("q")).collect()
    assert (rows[0].k.segment, rows[0].k.instrument) == (2, 35089)
    assert (rows[0].d.size, rows[0].d.price, rows[0].d.orders) == (10, 101.5, 3)
    assert rows[0].p == ["a", "b", "", "d", ""] and rows[0].q == ["a", "b", "d"]
    assert (rows[1].k.segment, rows[1].k.instrument, rows[1].d.orders) == (None, None, None)
    assert T.suffix_columns(df, "_api").columns == ["t_api", "ai_api", "r_api"]


def test_bars_on_hot_instrument_match_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(6000):  # instrument "HOT" holds 90% of ticks; many ties in time
        inst = "HOT" if i % 10 else f"I{i % 3}"
        rows.append((inst, base + dt.timedelta(seconds=(i * 7) % 5000), float((i * 37) % 101), i % 5, 6000 - i))
    df = spark.createDataFrame(rows, "instrument string, ts timestamp_ntz, price double, qty int, seq long")
    got = ohlcv(df.repartition(13), "5 minutes").toPandas()
    pdf = pd.DataFrame(rows, columns=["instrument", "ts", "price", "qty", "seq"])
    pdf["bar_start"] = pdf["ts"].dt.floor("5min")
    pdf = pdf.sort_values(["ts", "seq"])
    want = pdf.groupby(["instrument", "bar_start"]).agg(
        open=("price", "first"), high=("price", "max"), low=("price", "min"), close=("price", "last"),
        volume=("qty", "sum"), ticks=("price", "size")).reset_index()
    m = got.merge(want, on=["instrument", "bar_start"], suffixes=("", "_w"))
    assert len(m) == len(want) == len(got)
    for c in ("open", "high", "low", "close", "volume", "ticks"):
        assert (m[c] == m[c + "_w"]).all(), c
