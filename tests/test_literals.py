"""Python-literal payloads against Python's own ``str(dict)``."""

import ast
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickweave.operators import literals
from tickweave.operators.decode import decode

SCHEMA = "a string, n long, f double, b boolean, l array<string>, d struct<x string, y boolean>"


@pytest.fixture(scope="module")
def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def run(spark, schema, payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, v string")
    return [r.asDict(recursive=True) for r in decode(df, "v", schema, keep=["id"], python_repr=True).orderBy("id").collect()]


AWKWARD = ["None", "'", '"', "\\", "\\'", ", None,", ": True}", "[False]", "\n", "\t", "\x07", "\x00", "\x1b", "\x7f", "\xa0",
           "\xad", "​", " ", "", "\U000e0001", "\U0010ffff", "😀", "\\x41", "\\u0041", "\\U00000041", "nan", "it's",
           "\x01", "\x02", "\x03", "$1", "{", "}", "\\\\"]
TEXTS = st.one_of(st.none(), st.text(max_size=8), st.lists(st.sampled_from(AWKWARD), max_size=5).map("".join))
ROWS = st.lists(st.fixed_dictionaries({
    "a": TEXTS, "n": st.one_of(st.none(), st.integers(-2 ** 63, 2 ** 63 - 1)),
    "f": st.one_of(st.none(), st.floats()), "b": st.one_of(st.none(), st.booleans()),
    "l": st.one_of(st.none(), st.lists(TEXTS, max_size=3)),
    "d": st.one_of(st.none(), st.fixed_dictionaries({"x": TEXTS, "y": st.one_of(st.none(), st.booleans())}))}),
    min_size=1, max_size=60)


def has_half_pair(v):
    if isinstance(v, dict):
        return any(map(has_half_pair, v.values()))
    if isinstance(v, list):
        return any(map(has_half_pair, v))
    return isinstance(v, str) and any(0xD800 <= ord(c) <= 0xDFFF for c in v)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_any_dict_comes_back_or_is_quarantined(spark, schema, rows):
    payloads = [str(r) for r in rows]
    for want, raw, got in zip(rows, payloads, run(spark, schema, payloads)):
        if has_half_pair(want):  # no text has that character
            assert got["_corrupt_record"] == raw
            continue
        assert got["_corrupt_record"] is None, raw
        for k, v in want.items():
            same = isinstance(v, float) and isinstance(got[k], float) and math.isnan(v) and math.isnan(got[k])
            assert same or got[k] == v, (raw, k)


@pytest.mark.parametrize("text", AWKWARD)
def test_awkward_strings_under_both_quotes(spark, schema, text):
    rows = [{"a": text, "b": None}, {"a": text + "'", "b": True}, {"a": "'" + text + '"', "b": False}]
    for want, got in zip(rows, run(spark, schema, [str(r) for r in rows])):
        assert (got["a"], got["b"], got["_corrupt_record"]) == (want["a"], want["b"], None)


@pytest.mark.parametrize("raw", [
    "{'a': 'x\\/y', 'b': None}", "{'a': 'x\\0y'}", "{'a': '\\N{BULLET}'}", "{'a': '\\ud83d'}", "{'a': '\\x4'}", "{'a': '\\u00'}",
    "{'a': '\\U00110000'}", "{'a': '\\U0000d800'}", "{'a': 'open, 'b': None}", "{'a': b'x'}", "{'a': datetime.datetime(2024, 8, 8)}",
    "{'a': ('x',)}", "{1: 'x'}", "{'a': 'x' 'y'}", "None", "hello None", "{'a': None", "{'a': 'line\nbreak'}"])
def test_what_has_no_exact_json_form_is_quarantined(spark, schema, raw):
    got = run(spark, schema, [raw])[0]
    assert got["_corrupt_record"] == raw and got["a"] is None


def test_json_is_taken_as_it_is(spark, schema):
    payloads = ['{"a": "it\'s \\/ \\ud83d\\ude00 None, True", "b": true}', '{"a": null}', '{"a": "\\u0041\\n"}', None]
    got = run(spark, schema, payloads)
    assert [g["a"] for g in got] == ["it's / 😀 None, True", None, "A\n", None]
    assert all(g["_corrupt_record"] is None for g in got)


def test_wide_escapes_match_python(spark):
    texts = ["'\\U0001f600'", "'\\U00000041z\\U0010fffe'", "'\\\\U0001f600'"]
    df = spark.createDataFrame([(i, f"{{'a': {t}}}") for i, t in enumerate(texts)], "id int, v string")
    found = df.withColumn("k", literals.tokens(F.col("v"))).select("id", literals.to_json(F.col("v"), F.col("k")).alias("j"))
    got = found.select("id", F.from_json("j", "a string")["a"].alias("a")).orderBy("id").collect()
    assert [r["a"] for r in got] == [ast.literal_eval(t) for t in texts]


def test_long_strings_and_one_parse_a_row(spark, schema):
    long = "x'\\" * 200_000
    got = run(spark, schema, [str({"a": long, "b": None})])[0]
    assert got["a"] == long and got["_corrupt_record"] is None
    df = spark.createDataFrame([(1, "{'a': None}")], "id int, v string")
    plan = decode(df, "v", schema, keep=["id"], python_repr=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
