"""Steps that read their input once, and what is kept and cleaned between queries."""

import datetime as dt
import random

import __spark_entry__ as E
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tickweave import session
from tickweave.operators.bars import ohlcv
from tickweave.operators.reconcile import reconcile_subset, reconcile_volume
from tickweave.operators.sequence import sequence_steps

T0 = dt.datetime(2024, 8, 8)


@pytest.mark.parametrize("how", ["inner", "full_outer"])
def test_a_marked_side_is_reconciled_as_two_tables_are(spark, how):
    r = random.Random(2)
    rows = [(r.choice([1, 1, 1, 2, 3]), T0 + dt.timedelta(hours=r.randrange(90)), r.choice([None, 1.0, 2.5]),
             r.choice([None, 1, 2]), i, r.choice([None, True, False])) for i in range(300)] + [(4, T0, 1.0, None, 900, True)]
    ticks = spark.createDataFrame(rows, "instrument long, ts timestamp_ntz, price double, qty int, seq long, here boolean")
    want = reconcile_volume(ohlcv(ticks, "1 day"), ohlcv(ticks.where("here"), "1 day"), how=how)
    got = reconcile_subset(ticks, F.col("here"), "1 day", how=how)
    assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_reconciliation_scans_lineitem_once(spark):
    plan = E.queries()["volume_reconcile"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1


@pytest.mark.parametrize("name, wanted", [("order_book", "GreaterThanOrEqual(user_id,30)"), ("quote_snapshot_listed", "(event_type,purchase)")])
def test_filters_reach_the_scan(spark, name, wanted):
    assert wanted in E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bucket", ["minute", "hour", "day"])
def test_history_with_rows_without_a_time(spark, bucket):
    r = random.Random(3)
    rows = [(r.choice([1, 1, 2, None]), r.choice([None, T0 + dt.timedelta(minutes=r.randrange(300))]), r.choice([None, *range(500)]),
             i) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, ts timestamp_ntz, seq long, state long").dropDuplicates(["g", "ts", "seq"])
    got = sequence_steps(df, "g", ["ts", "seq"], "state", bucket=bucket, null_span=20).collect()
    low = dt.datetime.min
    for g in (1, 2, None):
        mine = sorted((x for x in got if x["g"] == g), key=lambda x: (x["ts"] or low, -1 if x["seq"] is None else x["seq"]))
        assert [x["step"] for x in mine] == list(range(1, len(mine) + 1))
        assert [x["prev_state"] for x in mine] == [None, *[x["state"] for x in mine[:-1]]]


def test_master_is_landed_once_and_tables_are_dropped(spark):
    session.clean_up()
    for name in ("instrument_equity", "instrument_series", "instrument_index_list"):
        E.queries()[name](spark, SF001).collect()
    assert sum("/master-" in p for p in session._WORK) == 1
    first = E.queries()["table_append"](spark, SF001)
    assert first.count() > 0 and len(session._TABLES) == 1
    session.clean_up()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ticks_")] and not session._WORK
    assert E.queries()["instrument_equity"](spark, SF001).columns  # landed again after the clean-up
    assert E.queries()["instrument_equity"](spark, SF001).count() >= 0
