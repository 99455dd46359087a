"""Continuity of numbered deliveries: offsets that never came, and offsets that came again.

A numbered stream (topic, partition, offset) is looked at in blocks of offsets,
so a partition spreads over as many tasks as it has blocks. Within a block,
runs of consecutive offsets are found by numbering; what crosses block edges is
settled on one or two rows per block. The runs seen so far are the state that
is carried to the next delivery: a compact table of ranges, of which only the
blocks that a delivery touches are opened again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("topic", "partition")
BLOCK = "block"


def blocked(deliveries: DataFrame, keys=KEYS, offset: str = "offset", block: int = 100_000) -> DataFrame:
    """``keys, block, offset, n``: how often each offset was delivered. Rows without a key or offset have no place."""
    known = F.col(offset).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    return (deliveries.where(known).groupBy(*keys, F.floor(F.col(offset) / block).alias(BLOCK), F.col(offset).alias("offset"))
            .agg(F.count(F.lit(1)).alias("n")))


def block_runs(offsets: DataFrame, keys=KEYS, total: str | None = None) -> DataFrame:
    """``keys, block, from_offset, to_offset``: runs of consecutive offsets within a block (``offsets`` are distinct).

    ``total``: a column to add up over each run, as ``n``.
    """
    place = F.row_number().over(Window.partitionBy(*keys, BLOCK).orderBy("offset"))
    aggs = [F.min("offset").alias("from_offset"), F.max("offset").alias("to_offset")]
    if total:
        aggs.append(F.sum(total).cast("long").alias("n"))
    return offsets.withColumn("__run", F.col("offset") - place).groupBy(*keys, BLOCK, "__run").agg(*aggs).drop("__run")


def merged(runs: DataFrame, block: int, keys=KEYS) -> DataFrame:
    """Runs (with ``n``) that go on over block edges as one. Only runs that touch an edge are compared, at most two a block."""
    edge = (F.col("from_offset") % block == 0) | ((F.col("to_offset") + 1) % block == 0)
    cols = [*keys, "from_offset", "to_offset", "n"]
    order = Window.partitionBy(*keys).orderBy("from_offset")
    new = F.coalesce(F.lag("to_offset").over(order) + 1 != F.col("from_offset"), F.lit(True))
    joined = (runs.where(edge).withColumn("__new", new.cast("int")).withColumn("__run", F.sum("__new").over(order))
              .groupBy(*keys, "__run").agg(F.min("from_offset").alias("from_offset"), F.max("to_offset").alias("to_offset"),
                                           F.sum("n").alias("n")))
    return runs.where(~edge).select(*cols).unionByName(joined.select(*cols))


def missing(state: DataFrame, keys=KEYS) -> DataFrame:
    """``keys, from_offset, to_offset, n``: ranges between the first and last known offset that never came."""
    inside = F.lead("from_offset").over(Window.partitionBy(*keys, BLOCK).orderBy("from_offset"))
    within = state.select(*keys, "to_offset", inside.alias("next"))
    ends = state.groupBy(*keys, BLOCK).agg(F.min("from_offset").alias("first"), F.max("to_offset").alias("to_offset"))
    across = ends.select(*keys, "to_offset", F.lead("first").over(Window.partitionBy(*keys).orderBy(BLOCK)).alias("next"))
    return (within.unionByName(across).where(F.col("next") > F.col("to_offset") + 1)
            .select(*keys, (F.col("to_offset") + 1).alias("from_offset"), (F.col("next") - 1).alias("to_offset"))
            .withColumn("n", F.col("to_offset") - F.col("from_offset") + 1))


def take(deliveries: DataFrame, state: DataFrame | None = None, keys=KEYS, offset: str = "offset",
         block: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """One delivery against what came before: ``(redelivered, new state)``.

    redelivered -- ``keys, from_offset, to_offset, n``: ranges that came more than once, in this delivery
                   or after an earlier one, and how many deliveries were too many
    state       -- runs per block of all offsets seen; write it, and give it to the next call (same ``block``).
                   :func:`missing` reads what is missing from it; a gap filled later is gone from it.

    ``deliveries`` is read for both results: hold it if it is dear to compute.
    """
    today = blocked(deliveries, keys, offset, block)
    seen = today.withColumn("before", F.lit(0))
    if state is not None:
        touched = today.select(*keys, BLOCK).distinct()
        opened = state.join(touched, [*keys, BLOCK], "left_semi").select(
            *keys, BLOCK, F.explode(F.sequence("from_offset", "to_offset")).alias("offset"), F.lit(0).alias("n"),
            F.lit(1).alias("before"))
        seen = seen.unionByName(opened).groupBy(*keys, BLOCK, "offset").agg(
            F.sum("n").alias("n"), F.max("before").alias("before"))
    extra = seen.withColumn("extra", F.col("n") + F.col("before") - 1).where((F.col("n") > 0) & (F.col("extra") > 0))
    new = block_runs(seen, keys)
    if state is not None:
        new = new.unionByName(state.join(touched, [*keys, BLOCK], "left_anti").select(*new.columns))
    return merged(block_runs(extra, keys, total="extra"), block, keys), new
