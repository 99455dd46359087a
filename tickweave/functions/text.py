"""Delimited-text helpers: compound keys, depth strings, positional splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compound_key(segment, instrument) -> Column:
    """``<segment>_<instrument>`` as used by candle and touchline messages."""
    return F.concat_ws("_", _c(segment).cast("string"), _c(instrument).cast("string"))


def split_compound_key(t) -> Column:
    """``"2_35089"`` -> struct(segment int, instrument long); bad parts -> NULL."""
    parts = F.split(_c(t), "_", 2)
    return F.struct(
        F.get(parts, 0).try_cast("int").alias("segment"),
        F.get(parts, 1).try_cast("long").alias("instrument"),
    )


def split_depth(info) -> Column:
    """Best ask/bid text ``size|price|orders`` -> struct(size long, price double, orders long)."""
    parts = F.split(_c(info), r"\|")
    return F.struct(
        F.get(parts, 0).try_cast("long").alias("size"),
        F.get(parts, 1).try_cast("double").alias("price"),
        F.get(parts, 2).try_cast("long").alias("orders"),
    )


def depth_text(size, price, orders) -> Column:
    return F.concat_ws("|", _c(size).cast("string"), _c(price).cast("string"), _c(orders).cast("string"))


def positional_fields(row_text, n: int, drop_empty: bool = False) -> Column:
    """Split ``a|b|c`` into an array of at most ``n`` text fields.

    Default keeps positions (an empty middle field stays empty and casts to NULL).
    ``drop_empty=True`` reproduces the older rule that removes empty fields
    first, which shifts later fields left.
    """
    parts = F.split(_c(row_text), r"\|")
    if drop_empty:
        parts = F.filter(parts, lambda x: x != F.lit(""))
    return F.slice(parts, 1, n)


def strip_trailing(text, ch: str = ",") -> Column:
    return F.regexp_replace(_c(text), "[" + ch + "]+$", "")


def suffix_columns(df, suffix: str):
    """Rename every column with a suffix (``_api`` / ``_s3``)."""
    return df.toDF(*[c + suffix for c in df.columns])
