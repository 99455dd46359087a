from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from tickweave.operators.decode import (decode, decode_checked, explode_ticks, prune_tick,
                                        split_quarantine, wrap_json_string)

SCHEMA = StructType([StructField("a", IntegerType()), StructField("p", DoubleType()),
                     StructField("s", StringType())])


def run(spark, payloads, **kw):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, v string")
    return {r.id: r for r in decode(df, "v", SCHEMA, keep=["id"], **kw).collect()}


def test_fixture_payloads(spark):
    r = run(spark, ['{"a": 1, "p": 2.5, "s": "x"}', "{'a': 1, 'p': 2.5, 's': 'x'}", '{"a": 1}',
                    '{"a": 1, "p": "abc", "s": "x"}', '{"a": 3.0, "p": 2.5}', '{"a": 99999999999}',
                    "{'a': None, 'p': 2.5}", "hello", None, '"{\\"a\\": 1}"'])
    assert (r[0].a, r[0].p, r[0].s, r[0]._corrupt_record) == (1, 2.5, "x", None)
    assert (r[1].a, r[1].p, r[1].s) == (1, 2.5, "x")            # single quotes accepted
    assert (r[2].a, r[2].p, r[2]._corrupt_record) == (1, None, None)  # missing field: NULL, clean
    assert (r[3].a, r[3].p, r[3].s) == (1, None, "x") and r[3]._corrupt_record  # bad field only
    assert r[4].a is None and r[4].p == 2.5 and r[4]._corrupt_record
    assert r[5].a is None and r[5]._corrupt_record               # int overflow
    assert (r[6].a, r[6].p) == (None, None) and r[6]._corrupt_record  # Python None: whole row
    assert r[7].a is None and r[7]._corrupt_record == "hello"
    assert (r[8].a, r[8]._corrupt_record) == (None, None)        # NULL payload: not corrupt
    assert r[9].a is None and r[9]._corrupt_record               # JSON inside a JSON string


def test_python_datetime_repr_is_quarantined(spark):
    raw = "{'a': 1, 'p': None, 's': datetime.datetime(2024, 8, 8, 9, 15)}"
    r = run(spark, [raw], python_repr=True)
    assert (r[0].a, r[0].p, r[0].s) == (None, None, None)
    assert r[0]._corrupt_record == raw  # the original text, not the normalised one


def test_python_literals_normalised_on_failures_only(spark):
    r = run(spark, ["{'a': None, 'p': 2.5, 's': 'x'}", "{'a': 1, 's': 'None, True'}",
                    "{'a': 2, 'p': 1.5, 's': 'ok'}"], python_repr=True)
    assert (r[0].a, r[0].p, r[0].s, r[0]._corrupt_record) == (None, 2.5, "x", None)
    assert r[1].s == "None, True"
    assert (r[2].a, r[2].p) == (2, 1.5)


def test_unwrap_json_in_json(spark):
    df = spark.createDataFrame([('{"a": 4, "s": "q\\"x"}',)], "v string")
    wrapped = df.select(wrap_json_string("v").alias("v"))
    out = decode(wrapped, "v", SCHEMA, unwrap=True).first()
    assert (out.a, out.s, out._corrupt_record) == (4, 'q"x', None)
    plain = decode(df, "v", SCHEMA, unwrap=True).first()
    assert plain.a == 4


def test_quarantine_reasons(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "p": 1.0}'), (2, "junk"), (3, None), (4, '{"p": 2.0}')],
                               "id int, v string")
    checked = decode_checked(df, "v", SCHEMA, required=["a"], keep=["id"])
    reasons = {r.id: r._reason for r in checked.collect()}
    assert reasons == {1: None, 2: "malformed", 3: "null_key", 4: "null_key"}
    good, bad = split_quarantine(checked)
    assert [r.id for r in good.collect()] == [1] and "_reason" not in good.columns
    assert bad.count() == 3


TICK = StructType([StructField("instrument_token", LongType()), StructField("last_price", DoubleType()),
                   StructField("depth", StructType([StructField("buy", ArrayType(LongType()))])),
                   StructField("ohlc", StructType([StructField("open", DoubleType())])),
                   StructField("exchange_timestamp", StringType())])


def test_tick_lists(spark):
    payloads = ['[{"instrument_token": 1, "last_price": 2.0, "depth": {"buy": [1]}, "ohlc": {"open": 1.0},'
                ' "exchange_timestamp": "2024-08-08 09:15:00"}, {"instrument_token": 2, "last_price": 3.0}]',
                "[]", "not json"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, v string")
    all_ticks = prune_tick(explode_ticks(df, "v", TICK, keep=["id"])).orderBy("id", "pos").collect()
    assert [(t.id, t.pos, t.instrument_token, t.has_depth) for t in all_ticks] == [(0, 0, 1, True), (0, 1, 2, False)]
    assert "depth" not in all_ticks[0].asDict() and "ohlc" not in all_ticks[0].asDict()
    first = explode_ticks(df, "v", TICK, keep=["id"], first_only=True).collect()
    assert [(t.id, t.instrument_token) for t in first] == [(0, 1)]
