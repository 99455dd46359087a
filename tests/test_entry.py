import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from tickweave.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["instrument", "bar_start", "bar_end"]


def test_every_query_has_oracle_or_reason():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(rows):
    def v(x):
        return round(x, 9) if isinstance(x, float) else x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    idx = [rel.columns.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _norm(got) == _norm(want)
