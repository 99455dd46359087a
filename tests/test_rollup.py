"""Stored partial bars and gapless series against bars straight from the ticks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickweave.operators import rollup
from tickweave.operators.bars import ohlcv

SCHEMA = "instrument string, ts timestamp_ntz, price double, qty int, seq long"
T0 = dt.datetime(2024, 2, 26, 22, 0)


def ticks(spark, n=1500, seed=1):
    r = random.Random(seed)
    rows = [(r.choice(["X"] * 9 + ["Y", None]), T0 + dt.timedelta(seconds=r.randrange(4 * 86_400)), r.choice([None, 1.0, 2.0, 5.5]),
             r.choice([None, 1, 2]), r.choice([None, *range(50)])) for _ in range(n)]
    # no two ticks of a bar tie in (time, sequence): ties are settled by price alone
    seen, out = set(), []
    for x in rows:
        if (x[0], x[1], x[4]) not in seen:
            seen.add((x[0], x[1], x[4]))
            out.append(x)
    return spark.createDataFrame([*out, ("X", None, 1.0, 1, 1)], SCHEMA)


def listed(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("kind", [{"width": 60}, {"width": 300}, {"width": 3600}, {"width": 86_400}, {"calendar": "day"},
                                  {"calendar": "week"}, {"calendar": "month"}])
def test_rolled_up_bars_equal_those_of_ticks(spark, kind):
    t = ticks(spark)
    got = rollup.bars_only(rollup.roll_up(rollup.partial_bars(t, 60), 60, **kind))
    want = ohlcv(t, kind.get("width"), calendar=kind.get("calendar"))
    assert got.columns == want.columns and listed(got) == listed(want)


def test_late_ticks_are_partial_bars_of_their_own_and_no_tick_is_read_again(spark, tmp_dir):
    t = ticks(spark)
    parts = [t.where(F.coalesce(F.col("qty"), F.lit(0)) == q) for q in (2, 0, 1)]  # any split of the ticks, in any order
    for p in parts:
        rollup.store(rollup.partial_bars(p, 60), tmp_dir + "/bars")
    stored = spark.read.schema(rollup.partial_bars(t, 60).schema).parquet(tmp_dir + "/bars")
    hours = rollup.roll_up(rollup.roll_up(stored, 60, 600), 600, 3600)
    assert listed(rollup.bars_only(hours)) == listed(ohlcv(t, "1 hour"))
    plan = hours._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "open_key" in plan and "LocalTableScan" not in plan and "Scan ExistingRDD" not in plan


@pytest.mark.parametrize("bad", [{"width": 90}, {"width": 30}, {}, {"width": 60, "calendar": "day"}])
def test_widths_that_do_not_fit(spark, bad):
    with pytest.raises(ValueError):
        rollup.roll_up(rollup.partial_bars(ticks(spark, 5), 60), 60, **bad)
    with pytest.raises(ValueError):
        rollup.roll_up(rollup.partial_bars(ticks(spark, 5), 7), 7, calendar="day")


def brute_fill(bars, width, whole_days):
    out = []
    for key in {b["instrument"] for b in bars}:
        mine = sorted((b for b in bars if b["instrument"] == key), key=lambda b: b["bar_start"])
        by = {b["bar_start"]: b for b in mine}
        days = sorted({b["bar_start"].date() for b in mine})
        spans = [(mine[0]["bar_start"], mine[-1]["bar_start"])] if whole_days else [
            (min(b for b in by if b.date() == d), max(b for b in by if b.date() == d)) for d in days]
        close = None
        for first, last in spans:
            at = first
            while at <= last:
                b = by.get(at)
                if b:
                    out.append((key, at, b["open"], b["high"], b["low"], b["close"], b["volume"], b["ticks"], False))
                    close = b["close"] if b["close"] is not None else close
                else:
                    out.append((key, at, close, close, close, close, 0, 0, True))
                at += dt.timedelta(seconds=width)
    return sorted(map(str, out))


@pytest.mark.parametrize("whole_days", [True, False])
@pytest.mark.parametrize("n, width", [(40, 3600), (400, 1800), (0, 60), (1, 60)])
def test_gaps_are_filled(spark, n, width, whole_days):
    t = ticks(spark, n, seed=3).where("ts IS NOT NULL")
    bars = ohlcv(t, width)
    got = rollup.fill_missing(bars.withColumn("note", F.lit(1)), width, whole_days=whole_days)
    cols = ["instrument", "bar_start", "open", "high", "low", "close", "volume", "ticks", "filled"]
    assert sorted(str(tuple(r)) for r in got.select(*cols).collect()) == brute_fill(bars.collect(), width, whole_days)
    assert got.schema["volume"].dataType == bars.schema["volume"].dataType
    if n == 40:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        with pytest.raises(ValueError):
            rollup.fill_missing(bars, 7)


def test_a_hot_instrument_is_dealt_by_days(spark):
    minutes = spark.range(20_000).select(
        F.lit("X").alias("instrument"), (F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"),
        F.lit(1.0).alias("price"), F.lit(1).alias("qty"), F.col("id").alias("seq")).where("seq % 5 != 0")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = rollup.fill_missing(ohlcv(minutes, 60), 60)
        sizes = [r["count"] for r in out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 19_999 and len(sizes) >= 5 and max(sizes) <= 19_999 / 2
