"""Connected components by alternating large-star and small-star.

Large-star links every larger neighbour of a node to the smallest node near
it; small-star links a node and its smaller neighbours to the smallest of them.
Alternating both shrinks any graph to stars around each component's smallest
node in a logarithmic number of rounds. Edges stay a distributed table, written
to the shared checkpoint folder each round; the driver sees one bit a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.work import cut, drop, hold

SALTS = 16  # a hub's neighbours are dealt over so many tasks when they meet its minimum


def connected(edges: DataFrame, salts: int = SALTS) -> DataFrame:
    """``(node, component)`` for every node of ``edges (u, v)`` (longs, either direction).

    ``component`` is the smallest node reachable. Loops and repeated edges do no
    harm; edges with a null end are left out; no edges give no rows.
    """
    now = hold(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _is_stars(now):
        after = cut(_small_star(_large_star(now, salts)), "stars", few=True)
        drop(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large_star(edges: DataFrame, salts: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = (both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
           .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    up = edges.select(F.col("v").alias("u"), F.col("u").alias("v"),
                      F.pmod(F.xxhash64("u"), F.lit(salts)).cast("int").alias("salt"))
    return up.join(low, ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Every node is either a centre or linked to exactly one centre."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    odd = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return odd.filter("out > 1 or (out = 1 and into = 1)").isEmpty()
