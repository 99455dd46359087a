"""Stream-stream reconciliation: equal to the batch comparison whatever comes late; state is given up."""

import datetime as dt
import os
import random

from tickweave.operators.reconcile import reconcile_volume
from tickweave.streaming.landing import land, progress_summary
from tickweave.streaming.live_reconcile import live_reconcile, settle, unsettled
from tickweave.streaming.sources import file_stream

SCHEMA = "instrument long, bar_start timestamp_ntz, close double, volume long"
T0 = dt.datetime(2024, 8, 8, 9, 0)


def test_equal_to_the_batch_comparison(spark, tmp_dir):
    r = random.Random(5)
    bars = [(i, T0 + dt.timedelta(minutes=m)) for m in range(60) for i in (1, 1, 2, 3)[1:]]
    sides = {"api": [], "s3": []}
    for name in sides:
        for i, at in bars:
            if r.random() < 0.8:
                delivery = min(3, at.minute // 15 + r.choice([0, 0, 0, 1, 2]))
                sides[name].append((delivery, (i, at, 1.0, r.choice([5, 6]))))
    schema = spark.createDataFrame([], SCHEMA).schema
    dropped = 0
    for d in range(4):
        for name, rows in sides.items():
            spark.createDataFrame([x for k, x in rows if k == d], SCHEMA).coalesce(1).write.mode("append").parquet(
                os.path.join(tmp_dir, name))
        out = live_reconcile(*[file_stream(spark, os.path.join(tmp_dir, n), schema) for n in sides], delay="2 minutes")
        q = land(out, tmp_dir + "/out", tmp_dir + "/ck", partition_by=(), available_now=True)
        q.awaitTermination()
        dropped += sum(p["droppedByWatermark"] for p in progress_summary(q))
        held = [s["numRowsTotal"] for s in q.lastProgress["stateOperators"]]
    assert dropped > 0  # some bars came after their time
    assert sum(held) < len(bars) / 3  # passed bars are not kept in state
    streamed = spark.read.schema(out.schema).parquet(tmp_dir + "/out")
    api, s3 = (spark.createDataFrame([x for _, x in sides[n]], SCHEMA) for n in ("api", "s3"))
    want = reconcile_volume(api, s3, how="full_outer")
    assert streamed.count() < want.count()
    assert 0 < unsettled(streamed, api, s3).count() < len(bars)
    got = settle(streamed, api, s3)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_nothing_streamed_yet_and_null_keys(spark):
    rows = [(None, T0, 1.0, 3), (1, None, 1.0, 3), (2, T0, 1.0, 3)]
    api, s3 = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[1:], SCHEMA)
    want = reconcile_volume(api, s3, how="full_outer")
    assert sorted(map(str, settle(want.limit(0), api, s3).collect())) == sorted(map(str, want.collect()))
