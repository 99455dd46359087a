import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF001
from tickweave.operators.bars import history_bars, ohlcv
from tickweave.sources.tables import event_ticks, table

SCHEMA = "instrument string, ts timestamp_ntz, price double, qty int, seq long"
T0 = dt.datetime(2024, 8, 8, 9, 15, 0)


def nine_ticks():
    return [("X", T0 + dt.timedelta(seconds=20 * i), 100.0 + i, i + 1, i) for i in range(9)]


def test_minute_bars_from_nine_ticks(spark):
    bars = ohlcv(spark.createDataFrame(nine_ticks(), SCHEMA), "1 minute").orderBy("bar_start").collect()
    assert [(b.open, b.close, b.volume) for b in bars] == [(100, 102, 6), (103, 105, 15), (106, 108, 24)]
    assert [b.bar_start for b in bars] == [T0, T0 + dt.timedelta(minutes=1), T0 + dt.timedelta(minutes=2)]
    assert all(b.bar_end - b.bar_start == dt.timedelta(minutes=1) for b in bars)


def test_same_clock_on_two_days_gives_two_bars(spark):
    rows = [("X", T0, 1.0, 1, 1), ("X", T0 + dt.timedelta(days=1), 2.0, 1, 2)]
    bars = ohlcv(spark.createDataFrame(rows, SCHEMA), "1 minute", label="HH:mm").collect()
    assert len(bars) == 2
    assert {b.bar_label for b in bars} == {"09:16"}


def test_equal_time_ticks_ordered_by_sequence(spark):
    rows = [("X", T0, 5.0, 1, 2), ("X", T0, 7.0, 1, 1), ("X", T0, 6.0, 1, 3)]
    b = ohlcv(spark.createDataFrame(rows, SCHEMA), "1 minute").first()
    assert (b.open, b.close, b.high, b.low) == (7.0, 6.0, 7.0, 5.0)


def test_shuffled_input_gives_same_bars(spark):
    ticks = event_ticks(table(spark, SF001, "events"))
    rows = ticks.collect()
    random.Random(7).shuffle(rows)
    shuffled = spark.createDataFrame(rows, ticks.schema).repartition(7)
    a = sorted(ohlcv(ticks, "1 hour").collect())
    b = sorted(ohlcv(shuffled, "1 hour").collect())
    assert a == b


def test_bar_properties(spark):
    ticks = event_ticks(table(spark, SF001, "events"))
    bars = ohlcv(ticks, "1 hour")
    bad = bars.where((F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close")))
    assert bad.count() == 0
    assert bars.agg(F.sum("volume")).first()[0] == ticks.agg(F.sum("qty")).first()[0]
    assert bars.agg(F.sum("ticks")).first()[0] == ticks.count()


def test_calendar_month_bars(spark):
    rows = [("X", dt.datetime(2024, 1, 31, 23, 0), 1.0, 1, 1), ("X", dt.datetime(2024, 2, 1, 1, 0), 2.0, 1, 2)]
    bars = ohlcv(spark.createDataFrame(rows, SCHEMA), calendar="month").orderBy("bar_start").collect()
    assert [b.bar_start for b in bars] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)]
    assert bars[0].bar_end == dt.datetime(2024, 2, 1)


def test_history_bounds_inclusive(spark):
    rows = nine_ticks()
    df = spark.createDataFrame(rows, SCHEMA)
    out = history_bars(df, "Aug 8 2024 091500", "Aug 8 2024 091600", 60).orderBy("bar_start").collect()
    # ticks at 09:15:00 .. 09:16:00 inclusive: 4 ticks, two bars
    assert sum(b.ticks for b in out) == 4


def test_time_only_ordering_and_start_label(spark):
    df = spark.createDataFrame(nine_ticks(), SCHEMA)
    a = sorted(ohlcv(df, "1 minute").drop("bar_end").collect())
    b = ohlcv(df, "1 minute", seq=None, label="HH:mm", label_side="start")
    assert sorted(b.drop("bar_end", "bar_label").collect()) == a
    assert sorted(r.bar_label for r in b.collect()) == ["09:15", "09:16", "09:17"]
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan  # fixed-width ordering key: hash aggregation


def test_exchange_zone_label_for_display_only(spark):
    rows = [("X", dt.datetime(2024, 8, 8, 3, 45, 10), 1.0, 1, 1)]
    b = ohlcv(spark.createDataFrame(rows, SCHEMA), "1 minute", label="HH:mm", label_side="start",
              label_zone="Asia/Kolkata").first()
    assert b.bar_start == dt.datetime(2024, 8, 8, 3, 45) and b.bar_label == "09:15"


def test_packed_order_key_exact_at_the_edges(spark):
    old = dt.datetime(1960, 1, 1, 0, 0, 30)
    rows = [("X", old, 1.0, 1, -(2 ** 63)), ("X", old, 2.0, 1, 2 ** 63 - 1), ("X", old, 3.0, 1, 0),
            ("Y", T0, 4.0, 1, 5), ("Y", T0 + dt.timedelta(microseconds=1), 5.0, 1, -5)]
    bars = ohlcv(spark.createDataFrame(rows, SCHEMA), "1 minute")
    got = {b.instrument: (b.open, b.close) for b in bars.collect()}
    assert got == {"X": (1.0, 2.0), "Y": (4.0, 5.0)}
    assert "HashAggregate" in bars._jdf.queryExecution().executedPlan().toString()
