"""Ordering keys for "first / last by (time, sequence)" aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the packed (ts, seq) ordering key; see order_key.
_TS_SHIFT_MICROS = 300_000_000_000_000_000      # makes any year 0001-9999 non-negative
_SEQ_SHIFT = "9223372036854775809"               # 2^63 + 1: makes any long positive; 0 stands for NULL
_SEQ_SPAN = "100000000000000000000"              # 10^20 > 2^64: room for a shifted long


def order_key(ticks: DataFrame, ts: str, seq: str | None) -> Column:
    """The (ts, seq) order of ticks as one aggregate-friendly key.

    With an integral ``seq`` the pair packs exactly into one DECIMAL(38,0):
    (micros + 3e17) * 10^20 + (seq + 2^63 + 1) keeps the lexicographic order and
    stays below 10^38 for every timestamp and long. A decimal buffer is
    mutable in place, so min_by / max_by then run as a hash aggregate. Any
    other ``seq`` (e.g. a struct of tie-breakers) orders by a struct, which
    Spark aggregates by sorting.

    A NULL time or sequence ranks below every value in both keys, so no tick is
    left out: of ticks at one time, one without a sequence comes first.
    """
    if not seq:
        return F.col(ts)
    if packable(ticks, ts, seq):
        micros = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")) + F.lit(_TS_SHIFT_MICROS),
                            F.lit(0)).cast("decimal(38,0)")
        shifted = F.coalesce(F.col(seq).cast("decimal(20,0)") + F.expr(f"CAST('{_SEQ_SHIFT}' AS DECIMAL(20,0))"),
                             F.lit(0).cast("decimal(20,0)"))
        return (micros * F.expr(f"CAST('{_SEQ_SPAN}' AS DECIMAL(38,0))") + shifted).cast("decimal(38,0)")
    return F.struct(F.col(ts), F.col(seq))


FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
               T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def packable(df: DataFrame, ts: str, seq: str | None) -> bool:
    """Whether (ts, seq) packs into the exact decimal key: a timestamp and one integral column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return bool(seq) and isinstance(types.get(seq), (T.IntegerType, T.LongType, T.ShortType)) and \
        isinstance(types.get(ts), (T.TimestampType, T.TimestampNTZType))


def fixed_width(df: DataFrame, cols) -> bool:
    """Whether all ``cols`` have fixed-width types (aggregation buffers updatable in place)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return all(isinstance(types.get(c), FIXED_WIDTH) for c in cols)
