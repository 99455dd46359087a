"""Offsets over several deliveries, and subscriptions over time, against brute force."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickweave.operators import offsets, subscriptions


def spans(values):
    out = []
    for v in sorted(values):
        if out and out[-1][1] == v - 1:
            out[-1][1] = v
        else:
            out.append([v, v])
    return [tuple(x) for x in out]


def frame(spark, rows):
    return spark.createDataFrame([("t", p, o) for p, o in rows], "topic string, partition int, offset long")


def got_ranges(df):
    return sorted((r["partition"], r["from_offset"], r["to_offset"], r["n"]) for r in df.collect())


@pytest.mark.parametrize("block, seed", [(4, 1), (1000, 2)])
def test_deliveries_in_turn(spark, tmp_dir, block, seed):
    r = random.Random(seed)
    runs = []
    for d in range(3):
        rows = [(p, o) for p in (0, 1) for o in range(d * 40, d * 40 + 45) if r.random() < 0.85]
        rows += [(0, o) for o in range(r.randrange(0, 60), 70)]  # a replay that may fill gaps
        runs.append(rows + r.sample(rows, 10))
    state, seen = None, defaultdict(set)
    for d, rows in enumerate(runs):
        again, new = offsets.take(frame(spark, rows).repartition(5), state, block=block)
        got = got_ranges(again)
        want = []
        for p in (0, 1):
            n = Counter(o for q, o in rows if q == p)
            extra = {o: c - (o not in seen[p]) for o, c in n.items()}
            want += [(p, a, b, sum(extra[o] for o in range(a, b + 1))) for a, b in spans([o for o, x in extra.items() if x])]
            seen[p] |= n.keys()
        assert got == sorted(want)
        new.write.parquet(f"{tmp_dir}/s{d}")
        state = spark.read.parquet(f"{tmp_dir}/s{d}")
        lost = [(p, a, b, b - a + 1) for p in (0, 1) for a, b in spans(set(range(min(seen[p]), max(seen[p]))) - seen[p])]
        assert got_ranges(offsets.missing(state)) == sorted(lost)


def test_odd_deliveries(spark):
    again, state = offsets.take(frame(spark, [(None, 1), (0, None), (0, 7), (0, 7), (0, 7)]), None, block=5)
    assert got_ranges(again) == [(0, 7, 7, 2)] and got_ranges(offsets.missing(state)) == []
    again, state = offsets.take(frame(spark, []), None)
    assert again.count() == 0 and state.count() == 0 and offsets.missing(state).count() == 0


def test_one_partition_is_dealt_over_many_tasks(spark):
    rows = spark.range(200_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, state = offsets.take(rows.where("offset % 1000 != 3"), None, block=1000)
        sizes = state.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 200
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert offsets.missing(state).count() == 200 and offsets.missing(state).agg(F.sum("n")).first()[0] == 200


T0 = dt.datetime(2024, 8, 8)
EVENTS = "segment int, instrument long, ts timestamp_ntz, seq long, on boolean"
TICKS = "id long, segment int, instrument long, ts timestamp_ntz, from_ts int, block int"


def brute(events, ticks):
    held = set()
    for i, _, key, t in [(x[0], x[1], x[2], x[3]) for x in ticks]:
        before = [(e[2], e[3], e[4]) for e in events if (e[0], e[1]) == key and e[2] is not None and t is not None and e[2] <= t]
        if before and max(before, key=lambda e: e[:2])[2]:
            held.add(i)
    return held


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_subscriptions(spark, bucket):
    r = random.Random(7)
    keys = [(1, 1)] * 30 + [(1, 2), (2, 1), (2, 2), (None, 3)]  # a hot instrument and a null key
    events = [(*r.choice(keys), T0 + dt.timedelta(hours=r.randrange(24 * 40)), i, r.random() < 0.5) for i in range(80)]
    events += [(2, 2, T0 + dt.timedelta(hours=5), 100, False), (2, 2, T0 + dt.timedelta(hours=5), 101, True), (1, 1, None, 102, True)]
    ticks = [(i, 0, r.choice(keys), T0 + dt.timedelta(minutes=30 * r.randrange(48 * 45))) for i in range(700)]
    ticks += [(9000, 0, (1, 1), None), (9001, 0, (9, 9), T0)]
    e = spark.createDataFrame(events, EVENTS)
    t = spark.createDataFrame([(i, *key, ts, 0, 0) for i, _, key, ts in ticks], TICKS)
    held = subscriptions.intervals(e, F.col("on"), bucket=bucket)
    want = brute(events, ticks)
    inside = subscriptions.during(t, held, bucket=bucket)
    assert inside.columns == t.columns and sorted(x["id"] for x in inside.collect()) == sorted(want)
    out = subscriptions.outside(t, held, bucket=bucket)
    assert sorted(x["id"] for x in out.collect()) == sorted({x[0] for x in ticks} - want)
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_events_and_no_ticks(spark):
    e, t = spark.createDataFrame([], EVENTS), spark.createDataFrame([(1, 1, 1, T0, 0, 0)], TICKS)
    held = subscriptions.intervals(e, F.col("on"))
    assert subscriptions.during(t, held).count() == 0 and subscriptions.outside(t, held).count() == 1
    some = subscriptions.intervals(spark.createDataFrame([(1, 1, T0, 1, True)], EVENTS), F.col("on"))
    assert subscriptions.during(t.limit(0), some).count() == 0 and subscriptions.during(t, some).count() == 1
