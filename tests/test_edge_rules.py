"""Rules for nulls, bad payloads, late ticks, money and ids: hand-made rows."""

import contextlib
import datetime as dt
import io
import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from tickweave.operators import orders as O
from tickweave.operators.bars import ohlcv
from tickweave.operators.broker import decode_broker_bars_checked
from tickweave.operators.decode import explode_ticks_checked
from tickweave.operators.quality import missing_report, zscore_outliers
from tickweave.operators.reconcile import reconcile_volume
from tickweave.operators.routing import DEAD_LETTER, request_table, route_all, subscribe
from tickweave.schemas import TICK_FEED2_RAW
from tickweave.streaming.correction import bars_by_day, correct_bars, touched_days, write_bars
from tickweave.streaming.landing import with_ingest_date

TICKS = "instrument string, ts timestamp_ntz, price double, qty int, seq long"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("options", [{"width": "5 hours"}, {"width": "1 hour"}, {"width": None, "calendar": "week"},
                                     {"width": None, "calendar": "month"}])
def test_correction_equals_batch_over_midnight(spark, tmp_dir, options):
    start = dt.datetime(2024, 7, 29)
    rows = [("X", start + dt.timedelta(hours=h, minutes=30), float(h % 7), 1, h) for h in range(0, 24 * 14, 2)]
    late = [("X", dt.datetime(2024, 8, 8, 22, 40), 50.0, 10, 9001), ("X", dt.datetime(2024, 8, 9, 1, 30), 60.0, 10, 9002)]
    df = lambda r: spark.createDataFrame(r, TICKS)
    landed, bars = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "bars")
    with_ingest_date(df(rows), "ts").write.partitionBy("ingest_date").parquet(landed)
    write_bars(bars_by_day(df(rows), **options), bars, dynamic=False)
    files = {p: os.path.getmtime(os.path.join(d, p)) for d, _, f in os.walk(bars) for p in f if p.endswith(".parquet")}
    with_ingest_date(df(late), "ts").write.mode("append").partitionBy("ingest_date").parquet(landed)
    width, calendar = options["width"], options.get("calendar")
    correct_bars(spark, landed, bars, touched_days(df(late), width, calendar), width, calendar=calendar)
    cols = ["instrument", "bar_start", "bar_end", "open", "high", "low", "close", "volume", "ticks"]
    got = sorted(spark.read.parquet(bars).select(*cols).collect())
    assert got == sorted(ohlcv(df(rows + late), **options).select(*cols).collect())
    if width:  # untouched days keep their files
        now = {p for d, _, f in os.walk(bars) for p in f if p.endswith(".parquet") and "2024_08_0" not in d}
        assert now and now <= set(files)


def test_open_and_close_count_ticks_without_a_sequence(spark):
    t = dt.datetime(2024, 8, 8, 9)
    for prices, seqs, want in (([1.0, 2.0, 3.0], [None, 7, None], (1.0, 2.0)), ([1.0, 2.0], [-5, None], (2.0, 1.0)),
                               ([4.0], [None], (4.0, 4.0))):
        rows = [("X", t + dt.timedelta(seconds=i if want[0] == 1.0 else 0), p, 1, s)
                for i, (p, s) in enumerate(zip(prices, seqs))]
        df = spark.createDataFrame(rows, TICKS)
        packed = ohlcv(df, "1 minute").first()
        struct = ohlcv(df.withColumn("seq", F.struct("seq")), "1 minute").first()
        assert (packed.open, packed.close) == (struct.open, struct.close)
        assert packed.open is not None and packed.close is not None
        if prices == [1.0, 2.0, 3.0]:
            assert (packed.open, packed.close) == (1.0, 3.0)
        else:
            assert (packed.open, packed.close) == want


def test_latest_row_with_null_order(spark):
    rows = [(1, None, None, 1.0), (1, None, 3, 2.0), (1, dt.datetime(2024, 1, 1), None, 3.0), (2, None, None, 4.0)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, seq long, v double")
    packed = {r.k: (r.v, r.updates) for r in O.latest_per_key(df, ["k"]).collect()}
    text = {r.k: (float(r.v), r.updates) for r in O.latest_per_key(df.withColumn("v", F.col("v").cast("string")), ["k"]).collect()}
    assert packed == text == {1: (3.0, 3), 2: (4.0, 1)}


def test_reconcile_status_with_nulls(spark):
    schema = "instrument long, bar_start timestamp_ntz, volume long"
    t = dt.datetime(2024, 8, 8)
    a = spark.createDataFrame([(None, t, 1), (1, t, None), (2, t, 5), (3, t, 5), (4, t, None), (5, t, 7)], schema)
    b = spark.createDataFrame([(None, t, 1), (1, t, None), (2, t, None), (3, t, 5), (6, t, 1)], schema)
    got = reconcile_volume(a, b, how="full_outer").collect()
    status = sorted((r.instrument_api or -1, r.instrument_s3 or -1, r.status) for r in got)
    assert status == sorted([(-1, -1, "api_only"), (-1, -1, "landed_only"), (1, 1, "match"), (2, 2, "differ"),
                             (3, 3, "match"), (4, -1, "api_only"), (5, -1, "api_only"), (-1, 6, "landed_only")])


def test_reports_on_empty_and_constant_input(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert [r.null_rate for r in missing_report(empty).collect()] == [None, None]
    same = spark.createDataFrame([("k", 1.0)] * 5 + [(None, 1.0)] * 20 + [(None, 900.0)], "k string, v double")
    assert [(r.k, r.v) for r in zscore_outliers(same, "k", "v").collect()] == [(None, 900.0)]
    assert zscore_outliers(same.limit(0), "k", "v").count() == 0


def test_money_keeps_four_decimals(spark):
    fills = spark.createDataFrame([(1, 7, 0, 0, 9, "BUY", 1.0, 83.0025, "F", dt.datetime(2024, 1, 1))] * 1000,
                                  "clientID long, appOrderID long, fill_no int, counterparty long, instrument long, "
                                  "side string, qty double, amount double, status string, trade_ts timestamp_ntz")
    assert O.positions(fills).first().bought_value == 83002.5


def test_a_long_request_list_is_a_table(spark):
    pairs = [(2, i) for i in range(200_000)]
    listed = request_table(spark, pairs, "seg int, id int")
    feed = spark.range(199_990, 200_010).select(F.lit(2).alias("seg"), F.col("id").cast("int").alias("id"))
    assert subscribe(feed, listed, ["seg", "id"]).count() == 10


def test_broker_rows_add_up(spark):
    good = json.dumps({"result": {"dataReponse": "1723108500|1|2|0.5|1.5|10|0|,noon|1|1|1|1|1|1|,1723108560|x|2|0|1|1|0|,"}})
    rows = [(3_000_000_000, good), (5, "not json"), (6, None), (7, json.dumps({"result": {}}))]
    got = decode_broker_bars_checked(spark.createDataFrame(rows, "i long, r string"), "r", 2, "i").collect()
    assert sorted((r.exchangeInstrumentID, r._reason or "") for r in got) == [
        (5, "no_data"), (6, "no_data"), (7, "no_data"), (3_000_000_000, ""), (3_000_000_000, "bad_number"),
        (3_000_000_000, "bad_time")]


def test_tick_lists_add_up(spark):
    rows = [(0, '[{"instrument_token": 1, "last_price": 2.5}, {"instrument_token": 2, "last_price": "x"}, "junk"]'),
            (1, "[]"), (2, None), (3, "{}"), (4, "[{"), (5, '[{"last_price": 1.0}]')]
    df = spark.createDataFrame(rows, "id int, v string")
    got = explode_ticks_checked(df, "v", TICK_FEED2_RAW, required=["instrument_token"], keep=["id"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r._reason)
    assert by[0] == [None, "malformed", "malformed"] and by[1] == ["empty_list"] and by[5] == ["null_key"]
    assert by[2] == by[3] == ["bad_list"] and len(by[4]) == 1 and by[4][0] is not None
    assert len(explode_ticks_checked(df, "v", TICK_FEED2_RAW, keep=["id"], first_only=True).collect()) == 6


def test_routing_keeps_every_row(spark):
    rows = [(1501, "full"), (1507, "full"), (1507, "partial"), (9999, "full"), (None, "full"), (1501, None), (1501, "odd")]
    got = route_all(spark.createDataFrame(rows, "MessageCode int, mode string")).collect()
    assert [r.topic for r in got] == ["message1501_json_full", "message1507_json_full"] + [DEAD_LETTER] * 5


def test_plans(spark):
    history = plan(E.queries()["order_history"](spark, SF001))
    assert "rangepartitioning" not in history and "ExistingRDD" not in history
    landed = plan(E.queries()["landed_minute_bars"](spark, SF001))
    assert "PartitionFilters: [isnotnull(status" in landed and landed.count("Exchange hashpartitioning") == landed.count(" Exchange ") == 1
    outliers = plan(E.queries()["quality_anomaly"](spark, SF001))
    assert "BroadcastHashJoin" in outliers and "hashpartitioning(instrument" not in outliers
    look_up = plan(E.queries()["instrument_equity"](spark, SF001))
    assert "PushedFilters: [IsNotNull(Series)" in look_up and "PartitionFilters: [isnotnull(ExchangeSegment" in look_up
    first = plan(E.queries()["tick_list_first"](spark, SF001))
    assert first.count("from_json") == 1
