"""Property checks: random tick sets (with ties) give the same bars as a brute force."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickweave.operators.bars import ohlcv

T0 = dt.datetime(2024, 8, 8, 9, 15)
tick = st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 600),       # seconds after T0 (ties likely)
                 st.integers(1, 500).map(lambda p: p / 4), st.integers(0, 9), st.integers(0, 50))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(tick, min_size=1, max_size=120, unique_by=lambda t: (t[0], t[1], t[4])))
def test_bars_equal_brute_force(spark, ticks):
    rows = [(i, T0 + dt.timedelta(seconds=s), p, q, seq) for i, s, p, q, seq in ticks]
    df = spark.createDataFrame(rows, "instrument string, ts timestamp_ntz, price double, qty int, seq long")
    got = ohlcv(df.repartition(5), "2 minutes").toPandas()
    pdf = pd.DataFrame(rows, columns=["instrument", "ts", "price", "qty", "seq"]).sort_values(["ts", "seq"])
    pdf["bar_start"] = pdf["ts"].dt.floor("2min")
    want = pdf.groupby(["instrument", "bar_start"]).agg(
        open=("price", "first"), high=("price", "max"), low=("price", "min"), close=("price", "last"),
        volume=("qty", "sum"), ticks=("price", "size")).reset_index()
    m = got.merge(want, on=["instrument", "bar_start"], suffixes=("", "_w"))
    assert len(m) == len(got) == len(want)
    for c in ("open", "high", "low", "close", "volume", "ticks"):
        assert (m[c] == m[c + "_w"]).all(), c
    assert (got["low"] <= got[["open", "close"]].min(axis=1)).all()
    assert (got["high"] >= got[["open", "close"]].max(axis=1)).all()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.datetimes(min_value=dt.datetime(1, 1, 2), max_value=dt.datetime(9999, 12, 30)),
                          st.integers(-(2 ** 63), 2 ** 63 - 1)), min_size=2, max_size=60, unique=True))
def test_packed_order_key_preserves_order(spark, pairs):
    from tickweave.functions.ordering import order_key

    df = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(pairs)], "i int, ts timestamp_ntz, seq long")
    got = [r.i for r in df.withColumn("k", order_key(df, "ts", "seq")).orderBy("k").collect()]
    want = [i for i, _ in sorted(enumerate(pairs), key=lambda x: x[1])]
    assert got == want
