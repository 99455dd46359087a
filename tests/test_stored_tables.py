"""Tables kept beside the landed data: latest state, trigram postings, compacted folders."""

import collections
import datetime as dt
import glob
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickweave.operators import text_index
from tickweave.operators.instruments import search_text
from tickweave.operators.orders import latest_per_key
from tickweave.sinks import compaction
from tickweave.streaming import state_table
from tickweave.streaming.landing import land
from tickweave.streaming.sources import file_stream

SCHEMA = "order long, state string, price double, ts timestamp_ntz, seq long"
T0 = dt.datetime(2024, 8, 8)


def updates(n, seed):
    r = random.Random(seed)
    return [(r.choice([None, *[1] * 20, *range(2, 30)]), r.choice("ABC"), r.choice([None, 1.5]),
             r.choice([None, T0 + dt.timedelta(minutes=r.randrange(500))]), i) for i in range(n)]


def listed(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def book(spark, rows):
    return latest_per_key(spark.createDataFrame(rows, SCHEMA), ["order"])


@pytest.mark.parametrize("cuts", [[0, 300], [0, 1, 1, 40, 41, 299, 300]])
def test_state_equals_the_batch_book_after_any_split(spark, tmp_dir, cuts):
    rows = updates(300, 1)
    like = spark.createDataFrame([], SCHEMA)
    assert state_table.current(spark, tmp_dir, like, ["order"]).count() == 0
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(1 + i % 2):  # a batch that runs again changes nothing
            state_table.merge_batch(spark.createDataFrame(rows[a:b], SCHEMA), i, tmp_dir, ["order"], buckets=4)
    assert listed(state_table.current(spark, tmp_dir, like, ["order"])) == listed(book(spark, rows))
    before = len(state_table.heads(spark, tmp_dir))
    assert state_table.drop_old(spark, tmp_dir) > 0 or len(cuts) == 2
    assert len(state_table.heads(spark, tmp_dir)) == before
    assert listed(state_table.current(spark, tmp_dir, like, ["order"])) == listed(book(spark, rows))


@pytest.mark.parametrize("where", ["before", "uncommitted", "after"])
def test_state_survives_a_restart_in_a_batch(spark, tmp_dir, where, monkeypatch):
    rows, lost = updates(90, 2), []
    root, bus, ck = (os.path.join(tmp_dir, x) for x in ("root", "bus", "ck"))
    commit = state_table._commit

    def committing(spark, root, i, touched):
        if i == 1 and where == "uncommitted" and not lost:
            lost.append(i)
            raise RuntimeError("lost")
        commit(spark, root, i, touched)

    monkeypatch.setattr(state_table, "_commit", committing)

    def step(df, i):
        fail = i == 1 and where != "uncommitted" and not lost
        if not fail or where == "after":
            state_table.merge_batch(df, i, root, ["order"], buckets=4)
        if fail:
            lost.append(i)
            raise RuntimeError("lost")

    like = spark.createDataFrame([], SCHEMA)
    for a in (0, 30, 60):
        spark.createDataFrame(rows[a:a + 30], SCHEMA).coalesce(1).write.mode("append").parquet(bus)
        for _ in range(2):
            try:
                (file_stream(spark, bus, like.schema).writeStream.foreachBatch(step).option("checkpointLocation", ck)
                 .trigger(availableNow=True).start().awaitTermination())
                break
            except StreamingQueryException as e:
                assert "lost" in str(e)
                if where == "uncommitted":  # readers still see the batch before
                    assert listed(state_table.current(spark, root, like, ["order"])) == listed(book(spark, rows[:30]))
    assert lost == [1]
    assert listed(state_table.current(spark, root, like, ["order"])) == listed(book(spark, rows))


MASTER = "ExchangeSegment string, ExchangeInstrumentID string, Name string, DisplayName string"


def test_text_search_equals_a_scan(spark, tmp_dir):
    r = random.Random(4)
    names = ["Gizmo", "gizmo big", "ZGIZM", "", None, "ab", "aaaa", "Ünder Straße", "日本語株", "x%y_z", "a.b*c", "gi zmo", "zmogi"]
    rows = [(r.choice(["A", "B", None]), str(i // 2), r.choice(names), r.choice(names)) for i in range(400)]
    master = spark.createDataFrame(rows, MASTER)
    index = text_index.build(master, tmp_dir + "/i", ["ExchangeSegment", "ExchangeInstrumentID"], ["Name", "DisplayName"], buckets=5)
    for needle in ["gizmo", "GIZ", "gi", "", "aaa", "straße", "日本語", "本語株", "%y_", ".b*", "mog", "no such", "big giz", "zmo"]:
        got, want = text_index.search(spark, index, needle), search_text(master, needle)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), needle
    empty = text_index.build(master.limit(0), tmp_dir + "/e", ["ExchangeInstrumentID"], ["Name"], buckets=2)
    assert text_index.search(spark, empty, "gizmo").count() == 0 and text_index.search(spark, empty, "g").count() == 0


def test_text_search_reads_postings_first_and_rows_by_candidate_folders(spark, tmp_dir):
    master = spark.createDataFrame([("A", str(i), f"name {i}", "gizmo") for i in range(50)], MASTER)
    index = text_index.build(master, tmp_dir + "/i", ["ExchangeInstrumentID"], ["Name", "DisplayName"], buckets=5)
    plan = text_index.search(spark, index, "name 17")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan and "PartitionFilters: [bucket" in plan.replace("isnotnull", "")
    assert "dynamicpruning" in plan  # folders without a candidate are not read


def test_postings_are_dealt_by_their_number_and_a_hot_trigram_is_cut(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(text_index, "POSTINGS_PER_TASK", 1000, raising=False)
    rows = [("A", str(i // 2), "gizmo", f"n{i % 7}") for i in range(4000)]  # every key twice
    index = text_index.build(spark.createDataFrame(rows, MASTER).coalesce(1), tmp_dir + "/i", ["ExchangeInstrumentID"],
                             ["Name", "DisplayName"], buckets=1)
    stored = spark.read.parquet(index.path + "/postings").withColumn("file", F.input_file_name()).collect()
    per_file, hot = (collections.Counter(r["file"] for r in stored if r["gram"] in g) for g in ({"giz", "izm", "zmo"}, {"giz"}))
    assert len(stored) == 3 * 2000 and len({(r["gram"], r["k"]) for r in stored}) == len(stored)  # distinct over all files
    assert len(per_file) >= 12 and max(per_file.values()) <= 1500
    assert len(hot) >= 3 and len(text_index.search(spark, index, "IZMO").collect()) == 4000


def test_rows_of_one_folder_are_written_by_several_tasks(spark, tmp_dir):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        rows = spark.range(20000, numPartitions=8).select(F.col("id").cast("string").alias("i"), F.sha2(F.col("id").cast("string"), 256).alias("n"))
        index = text_index.build(rows, tmp_dir + "/i", ["i"], ["n"], buckets=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(index.path + "/rows/__part=0/*.parquet")) > 4
    assert index.rows(spark).count() == 20000


LANDED = "id long, day string"


def landing(spark, tmp_dir, rows, files=6):
    bus, data, ck = (os.path.join(tmp_dir, x) for x in ("bus", "data", "ck"))
    spark.createDataFrame(rows, LANDED).repartition(files).write.mode("append").parquet(bus)
    stream = file_stream(spark, bus, spark.createDataFrame([], LANDED).schema, max_files_per_trigger=1)
    land(stream, data, ck, partition_by=("day",), available_now=True).awaitTermination()
    return data, spark.createDataFrame([], LANDED).schema


def test_compaction_beside_a_running_sink(spark, tmp_dir, monkeypatch):
    store = os.path.join(tmp_dir, "packed")
    rows = [(i, f"2024-08-0{1 + i % 3} a%b") for i in range(300)]  # folder names that need escapes
    data, schema = landing(spark, tmp_dir, rows)
    files = compaction.landed_files(spark, data, schema).count()
    same = lambda want: sorted(map(tuple, compaction.read_compacted(spark, data, store, schema).collect())) == sorted(want)
    assert files >= 12 and same(rows)

    def crash(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # dies after its rows are written, before they count
        m.setattr(compaction.uuid, "uuid4", lambda: type("U", (), {"hex": "dead" * 8}))
        create = type(spark).createDataFrame
        m.setattr(type(spark), "createDataFrame", lambda self, d, s=None, *a, **k: crash() if s == compaction.LISTED and d else
                  create(self, d, s, *a, **k))
        with pytest.raises(RuntimeError):
            compaction.compact(spark, data, store, schema, ["day"], target_bytes=1 << 20)
    assert os.path.isdir(f"{store}/runs/deaddeaddead") and same(rows)

    assert compaction.compact(spark, data, store, schema, ["day"], target_bytes=1 << 20) == files
    assert same(rows)
    packed = [f for r, _, fs in os.walk(f"{store}/runs") for f in fs if f.endswith(".parquet") and "dead" not in r]
    assert len(packed) == 3  # one file per day
    assert compaction.compact(spark, data, store, schema, ["day"], target_bytes=1 << 20) == 0  # nothing new

    more = [(1000 + i, f"2024-08-0{2 + i % 3} a%b") for i in range(100)]  # the sink goes on: its log is whole
    landing(spark, tmp_dir, more, files=3)
    assert same(rows + more)
    assert compaction.compact(spark, data, store, schema, ["day"], target_bytes=1 << 20) > 0 and same(rows + more)
    assert sorted(map(tuple, spark.read.schema(schema).parquet(data).collect())) == sorted(rows + more)


def test_large_files_are_left_and_large_folders_are_dealt(spark, tmp_dir):
    data, schema = landing(spark, tmp_dir, [(i, "d") for i in range(3000)], files=5)
    sizes = [r["bytes"] for r in compaction.landed_files(spark, data, schema).collect()]
    assert compaction.compact(spark, data, tmp_dir + "/p", schema, ["day"], target_bytes=min(sizes)) == 0
    target = sum(sizes) // 2 + 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a few KB would be one task
    try:
        assert compaction.compact(spark, data, tmp_dir + "/p", schema, ["day"], target_bytes=target) == 5
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    runs = [f for _, _, fs in os.walk(tmp_dir + "/p/runs") for f in fs if f.endswith(".parquet")]
    assert len(runs) == 2  # as its bytes fill
    assert compaction.read_compacted(spark, data, tmp_dir + "/p", schema).select(F.count_distinct("id")).first()[0] == 3000


def test_nothing_landed(spark, tmp_dir):
    schema = spark.createDataFrame([], LANDED).schema
    spark.createDataFrame([], LANDED).write.partitionBy("day").parquet(tmp_dir + "/data")
    assert compaction.compact(spark, tmp_dir + "/data", tmp_dir + "/p", schema, ["day"]) == 0
    assert compaction.read_compacted(spark, tmp_dir + "/data", tmp_dir + "/p", schema).count() == 0
