"""Data quality: missing values and anomalies (rule flags, z-scores)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.operators.reconcile import column_profile
from tickweave.session import work_path


def missing_report(df: DataFrame) -> DataFrame:
    """Per column: type, non-NULL count, rows and NULL rate (NULL for an empty table)."""
    p = column_profile(df)
    return p.withColumn("null_rate", F.lit(1.0) - F.try_divide(F.col("non_null"), F.col("rows")))


def handle_missing(df: DataFrame, required=(), fill: dict | None = None) -> DataFrame:
    """Drop rows missing a required field, fill the others by rule."""
    out = df.na.drop(subset=list(required)) if required else df
    return out.na.fill(fill) if fill else out


BAR_RULES = {
    "non_positive_price": "least(open, high, low, close) <= 0",
    "high_below_low": "high < low",
    "open_outside_range": "open < low OR open > high",
    "close_outside_range": "close < low OR close > high",
    "negative_volume": "volume < 0",
}


def bar_rule_flags(bars: DataFrame) -> DataFrame:
    """Add one boolean column per rule in :data:`BAR_RULES` plus ``any_flag``."""
    out = bars
    for name, cond in BAR_RULES.items():
        out = out.withColumn(name, F.coalesce(F.expr(cond), F.lit(False)))
    any_flag = F.lit(False)
    for name in BAR_RULES:
        any_flag = any_flag | F.col(name)
    return out.withColumn("any_flag", any_flag)


def bar_rule_counts(bars: DataFrame) -> DataFrame:
    """Rows checked and rows flagged per rule (one pass, one row per rule)."""
    flagged = bar_rule_flags(bars)
    agg = flagged.agg(F.count(F.lit(1)).alias("checked"),
                      *[F.count_if(F.col(n)).alias(n) for n in BAR_RULES])
    entries = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("flagged")) for n in BAR_RULES]
    return agg.select("checked", F.explode(F.array(*entries)).alias("e")).select("e.rule", "e.flagged", "checked")


def zscore_outliers(df: DataFrame, key: str, value: str, threshold: float = 3.0) -> DataFrame:
    """Rows whose value is more than ``threshold`` population standard deviations
    from its key's mean. A NULL key is a key; keys without spread have no outliers.

    The statistics (one row per key) are written to the shared folder first, so
    their size is known: Spark broadcasts them if they are small, and the raw
    rows are then never exchanged. Else both sides are shuffled and AQE can
    split a hot key."""
    spark = df.sparkSession
    stats = df.groupBy(F.col(key).alias("__key")).agg(F.avg(value).alias("__mean"), F.stddev_pop(value).alias("__std"))
    path = work_path(spark, "key-stats")
    stats.where(F.col("__std") > 0).write.parquet(path)
    known = spark.read.schema(stats.schema).parquet(path)
    z = F.try_divide(F.col(value) - F.col("__mean"), F.col("__std"))
    return (df.join(known, F.col(key).eqNullSafe(F.col("__key"))).withColumn("z", z)
            .where(F.abs(F.col("z")) > threshold)
            .drop("__key", "__mean", "__std"))
