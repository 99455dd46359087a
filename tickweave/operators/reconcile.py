"""Reconcile bars of two sources (landed ticks vs broker bars) and profile tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.ordering import order_key
from tickweave.functions.text import suffix_columns
from tickweave.operators.bars import ohlcv


def reconcile_volume(api: DataFrame, landed: DataFrame, keys=("instrument", "bar_start"),
                     how: str = "inner", api_suffix: str = "_api", landed_suffix: str = "_s3",
                     tolerance: float = 0.0) -> DataFrame:
    """Join two bar tables on (instrument, bar time) and report the volume gap.

    how='inner'      -- only bars present on both sides (the original comparison)
    how='full_outer' -- also bars missing on one side, with a ``status`` column:
                        match | differ | api_only | landed_only
    Columns of each side carry a suffix; ``Volume_Difference = volume_api - volume_landed``.
    When both inputs come from :func:`ohlcv` on the same keys they are already
    hash partitioned on them, so the join adds no shuffle.
    """
    a = suffix_columns(api, api_suffix).withColumn("__a", F.lit(True))
    b = suffix_columns(landed, landed_suffix).withColumn("__b", F.lit(True))
    cond = [a[k + api_suffix] == b[k + landed_suffix] for k in keys]
    j = a.join(b, cond, how)
    va, vb = F.col("volume" + api_suffix), F.col("volume" + landed_suffix)
    j = j.withColumn("Volume_Difference", va - vb)
    if how != "inner":
        # Each side carries a presence flag: a bar with NULL keys is still seen by its side.
        status = (F.when(F.col("__b").isNull(), F.lit("api_only"))
                  .when(F.col("__a").isNull(), F.lit("landed_only"))
                  .when(va.eqNullSafe(vb) | F.coalesce(F.abs(va - vb) <= F.lit(tolerance), F.lit(False)),
                        F.lit("match"))
                  .otherwise(F.lit("differ")))
        j = j.withColumn("status", status)
    return j.drop("__a", "__b")


def reconcile_subset(ticks: DataFrame, landed, width="1 day", how: str = "inner", api_suffix: str = "_api",
                     landed_suffix: str = "_s3") -> DataFrame:
    """:func:`reconcile_volume` of the bars of all ticks and of those where ``landed`` is true, in one pass.

    One scan and one shuffle: the landed side's bars are conditional aggregates
    beside the others', so neither side is read or joined again. ``ticks``:
    ``instrument, ts, price, qty, seq`` and what ``landed`` (a column) needs.
    """
    mine = F.when(landed, order_key(ticks, "ts", "seq"))
    price, qty = F.when(landed, F.col("price")), F.when(landed, F.col("qty"))
    side = {"open": F.min_by(F.col("price"), mine), "high": F.max(price), "low": F.min(price), "close": F.max_by(F.col("price"), mine),
            "volume": F.sum(qty), "ticks": F.count(F.when(landed, F.lit(1)))}
    bars = ohlcv(ticks, width, extra_aggs={f"__{c}": a for c, a in side.items()})
    keys, there = ["instrument", "bar_start", "bar_end"], F.col("__ticks") > 0
    out = [F.col(c).alias(c + api_suffix) for c in [*keys, *side]]
    out += [F.when(there, F.col(c)).alias(c + landed_suffix) for c in keys]
    out += [F.when(there, F.col(f"__{c}")).alias(c + landed_suffix) for c in side]
    gap = F.when(there, F.col("volume") - F.col("__volume"))
    out.append(gap.alias("Volume_Difference"))
    if how == "inner":
        return bars.where(there).select(*out)
    same = F.col("volume").eqNullSafe(F.col("__volume"))
    return bars.select(*out, F.when(~there, F.lit("api_only")).when(same, F.lit("match")).otherwise(F.lit("differ")).alias("status"))


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row: non-NULL count of every column (named like the column)."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: name, Spark type, non-NULL count, row count.

    One pass over the data (a single global aggregate with partial counts per
    task), then an in-row unpivot; the type names come from the schema.
    """
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(f"`{c}`")).alias(f"__n{i}") for i, c in enumerate(df.columns)])
    entries = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                        F.col(f"__n{i}").alias("non_null"))
               for i, f in enumerate(df.schema.fields)]
    return (counts.select(F.col("__rows").alias("rows"), F.explode(F.array(*entries)).alias("e"))
            .select("e.column", "e.dtype", "e.non_null", "rows"))
