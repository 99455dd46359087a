import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF001
from tickweave.operators.bars import ohlcv
from tickweave.sources.tables import event_ticks, table
from tickweave.streaming.landing import land, progress_summary
from tickweave.streaming.live_bars import live_bars
from tickweave.streaming.sources import file_stream

SCHEMA = "instrument string, ts timestamp_ntz, price double, qty int, seq long"


def _push(spark, folder, n, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, f"part{n}"))


def test_late_tick_dropped_and_counted(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    os.makedirs(src)
    schema = spark.createDataFrame([], SCHEMA).schema
    d = dt.datetime(2024, 8, 8, 9, 0, 0)
    batches = [
        [("X", d.replace(minute=15, second=1), 1.0, 1, 1), ("X", d.replace(minute=15, second=40), 2.0, 1, 2),
         ("X", d.replace(minute=16, second=5), 3.0, 1, 3)],
        [("X", d.replace(minute=20), 4.0, 1, 4)],
        [("X", d.replace(minute=15, second=59), 9.0, 1, 5)],
    ]
    dropped = 0
    for i, rows in enumerate(batches):
        _push(spark, src, i, rows)
        stream = file_stream(spark, src, schema, fmt="parquet", recursive=True)
        bars = live_bars(stream, "1 minute", "1 minute")
        q = land(bars, out, ck, partition_by=(), available_now=True)
        q.awaitTermination()
        dropped += sum(p["droppedByWatermark"] for p in progress_summary(q))
    got = sorted((r.bar_start.minute, r.open, r.close, r.volume) for r in spark.read.parquet(out).collect())
    assert got == [(15, 1.0, 2.0, 2), (16, 3.0, 3.0, 1)]
    assert dropped == 1


def test_stream_equals_batch(spark, tmp_dir):
    ev = table(spark, SF001, "events")
    stream = file_stream(spark, SF001, ev.schema, glob="events.parquet")
    bars = live_bars(event_ticks(stream), "1 hour", "5 minutes")
    q = land(bars, os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"), partition_by=(), available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(tmp_dir, "o"))
    cutoff = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=5)
    want = ohlcv(event_ticks(ev), "1 hour").where(F.col("bar_end") <= F.lit(cutoff))
    cols = want.columns
    assert sorted(got.select(*cols).collect()) == sorted(want.collect())


def test_landing_reports_observed_metrics(spark, tmp_dir):
    from tickweave.operators.decode import decode_checked
    from tickweave.schemas import TICK_FEED1
    from tickweave.streaming.landing import land_checked, observed, with_ingest_date
    from tickweave.functions.timeutil import from_epoch1980

    src = os.path.join(tmp_dir, "src")
    rows = [('{"ExchangeInstrumentID": 1, "LastUpdateTime": 100, "LastTradedPrice": 1.5}',), ("junk",), (None,)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.json(src)
    stream = file_stream(spark, src, spark.createDataFrame([], "value string").schema, fmt="json")
    checked = decode_checked(stream, "value", TICK_FEED1, required=["ExchangeInstrumentID", "LastUpdateTime"])
    checked = observed(with_ingest_date(checked, from_epoch1980("LastUpdateTime")))
    q = land_checked(checked, os.path.join(tmp_dir, "d"), os.path.join(tmp_dir, "c"), available_now=True)
    q.awaitTermination()
    report = [r for r in progress_summary(q) if r["observed"]]
    m = report[0]["observed"]["landing"]
    assert (m["rows"], m["corrupt"], m["quarantined"]) == (3, 1, 2)
    landed = spark.read.parquet(os.path.join(tmp_dir, "d"))
    assert {r["status"]: r["count"] for r in landed.groupBy("status").count().collect()} == {"clean": 1, "quarantine": 2}


def test_landed_day_read_prunes_partitions(spark, tmp_dir):
    import contextlib
    import io

    from tickweave.sources.files import read_landed
    from tickweave.streaming.landing import with_ingest_date

    rows = [("X", dt.datetime(2024, 8, d, 9, 15), 1.0, 1, d) for d in (7, 8, 9)]
    ticks = with_ingest_date(spark.createDataFrame(rows, SCHEMA), "ts")
    ticks.write.partitionBy("ingest_date").parquet(os.path.join(tmp_dir, "landed"))
    day = read_landed(spark, os.path.join(tmp_dir, "landed"), day="2024_08_08")
    assert [r.seq for r in day.collect()] == [8]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        day.explain()
    assert "PartitionFilters: [isnotnull(ingest_date" in buf.getvalue()
