"""Registered queries: Spark callables (spark, sf_dir) -> DataFrame and their oracle SQL."""

from tickweave.plans.catalog import REGISTRY, oracle_sql, queries  # noqa: F401
from tickweave.plans import (  # noqa: F401  (import fills the registry)
    bar_queries,
    decode_queries,
    reconcile_queries,
    order_queries,
    io_queries,
    feed_queries,
    rollup_queries,
    index_queries,
)
