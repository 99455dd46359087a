"""Late ticks: judged by arrival order alone, landed once whatever runs again, and in the bars at the end."""

import datetime as dt
import os
import random

import pytest
from pyspark.errors import StreamingQueryException

from tickweave.operators.bars import ohlcv
from tickweave.streaming import late
from tickweave.streaming.landing import land, with_ingest_date
from tickweave.streaming.live_bars import live_bars
from tickweave.streaming.sources import file_stream

SCHEMA = "instrument string, ts timestamp_ntz, price double, qty int, seq long"
T0 = dt.datetime(2024, 8, 8, 9, 0)


def ticks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def at(minutes, seq, instrument="X"):
    return (instrument, T0 + dt.timedelta(minutes=minutes), float(seq % 13), seq % 5, seq)


def rows_of(spark, root):
    schema = late.landed_schema(ticks(spark, []))
    return sorted((r["batch_id"], r["seq"], r["late"]) for r in late.landed(spark, root, schema).collect())


BATCHES = [[at(0, 1), at(10, 2)], [at(4, 3), at(5, 4), at(6, 5)], [], [at(30, 6), at(1, 7)], [at(24, 8), at(26, 9)],
           [("X", None, 1.0, 1, 10)], [at(20, 11)]]


def brute(batches, delay=5):
    out, latest = [], None
    for i, rows in enumerate(batches):
        for r in rows:
            out.append((i, r[4], latest is not None and r[1] is not None and r[1] < latest - dt.timedelta(minutes=delay)))
        latest = max([t for t in (latest, *[r[1] for r in rows]) if t is not None], default=None)
    return sorted(out)


def test_batches_are_judged_by_those_before_them(spark, tmp_dir):
    for i, rows in enumerate(BATCHES):
        late.land_batch(ticks(spark, rows), i, tmp_dir, "5 minutes")
    want = brute(BATCHES)
    assert rows_of(spark, tmp_dir) == want and any(w[2] for w in want)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_dir):
    for i, rows in enumerate(BATCHES):
        for _ in range(1 + i % 3):
            late.land_batch(ticks(spark, rows).repartition(3), i, tmp_dir, "5 minutes")
    assert rows_of(spark, tmp_dir) == brute(BATCHES)


@pytest.mark.parametrize("where", ["before the rows", "between rows and watermark", "after the watermark"])
def test_restart_in_the_middle_of_a_batch(spark, tmp_dir, where, monkeypatch):
    root, bus, ck = (os.path.join(tmp_dir, x) for x in ("root", "bus", "ck"))
    schema = ticks(spark, []).schema
    lost = []
    write_mark = late._write_mark

    def mark(spark, root, i, latest):
        if i == 1 and not lost and where == "between rows and watermark":
            lost.append(i)
            raise RuntimeError("lost")
        write_mark(spark, root, i, latest)

    monkeypatch.setattr(late, "_write_mark", mark)

    def step(df, i):
        fail = i == 1 and not lost and where != "between rows and watermark"
        if not fail or where == "after the watermark":
            late.land_batch(df, i, root, "5 minutes")
        if fail:
            lost.append(i)
            raise RuntimeError("lost")

    batches = [b for b in BATCHES[:4] if b]
    for rows in batches:
        ticks(spark, rows).coalesce(1).write.mode("append").parquet(bus)
        for _ in range(2):
            q = (file_stream(spark, bus, schema).writeStream.foreachBatch(step).option("checkpointLocation", ck)
                 .trigger(availableNow=True).start())
            try:
                q.awaitTermination()
                break
            except StreamingQueryException as e:
                assert "lost" in str(e)
    assert lost == [1] and rows_of(spark, root) == brute(batches)


def test_bars_equal_those_of_all_ticks_in_any_order(spark, tmp_dir):
    r = random.Random(3)
    all_rows = [at(r.random() * 60 * 24 * 4, i, r.choice("XYZ")) for i in range(600)]
    arrivals = sorted(all_rows, key=lambda x: x[1] + dt.timedelta(minutes=r.choice([0, 0, 0, 700, 3000])))
    batches = [arrivals[i:i + 120] + r.sample(arrivals[:i + 1], min(i + 1, 10)) for i in range(0, 600, 120)]
    root, bus = os.path.join(tmp_dir, "root"), os.path.join(tmp_dir, "bus")
    schema = ticks(spark, []).schema
    for rows in batches:
        ticks(spark, rows).write.mode("append").parquet(bus)
        late.land_marking_late(file_stream(spark, bus, schema), root, os.path.join(tmp_dir, "ck")).awaitTermination()
    landed_schema = late.landed_schema(ticks(spark, []))
    assert rows_of(spark, root) == brute(batches)
    bars = with_ingest_date(live_bars(late.on_time_stream(spark, root, landed_schema).select(*ticks(spark, []).columns),
                                      "1 hour", "5 minutes", dedupe_on=("instrument", "seq")), "bar_start")
    land(bars, f"{root}/live", f"{root}/lck", available_now=True).awaitTermination()
    live = spark.read.schema(bars.schema).parquet(f"{root}/live")
    view = lambda df: df.select(*ticks(spark, []).columns).dropDuplicates(["instrument", "seq"])
    want = sorted(map(tuple, ohlcv(ticks(spark, all_rows), "1 hour").collect()))
    for _ in range(2):  # a correction can run again
        got = late.correct(spark, root, landed_schema, live, f"{root}/fixed", "1 hour", ticks_view=view)
        assert sorted(map(tuple, got.drop("ingest_date").collect())) == want
    like = late.bars_by_day(ticks(spark, []), "1 hour")
    before = late.current_bars(spark, live, f"{root}/never", like)  # no correction run yet: the live bars
    assert before.count() == live.count()
