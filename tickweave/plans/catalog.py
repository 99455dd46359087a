"""Query registry.

Each registered query is a callable ``(spark, sf_dir) -> DataFrame`` that
reads whole driver tables, plus (where SQL can say it) an equivalent DuckDB SQL
text over the same tables, used as an independent oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tickweave.session import configure


@dataclass
class QuerySpec:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple = field(default_factory=tuple)


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None = None, ids=()):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, run, sql.strip() if sql else None, tuple(ids))
        return run
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.fn for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.sql for k, v in REGISTRY.items() if v.sql}


# ---- DuckDB SQL fragments shared by oracle texts --------------------------

def sql_bucket(ts: str, seconds: int) -> str:
    """Epoch-aligned bucket start, same rule as Spark's tumbling window."""
    us = int(seconds) * 1_000_000
    e = f"epoch_us({ts})"
    return f"make_timestamp({e} - ((({e} % {us}) + {us}) % {us}))"


def sql_bucket_end(ts: str, seconds: int) -> str:
    return f"({sql_bucket(ts, seconds)} + INTERVAL {int(seconds)} SECOND)"


SQL_EVENT_QTY = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"
