"""Sharding by a hierarchical weighted hash tree.

A row's key descends region, rack and shard levels. At each level every child
draws an exponential variate ``-ln(u) / weight``, where ``u`` is a hash of the
key and the child's id, and the smallest draw wins. A child therefore receives
a share equal to its weight, and a draw depends on nothing but the key and that
child, so a weight that changes moves rows only into or out of the subtrees
whose weights change.

Placement is a column expression: no shuffle, no state, the same on every
executor and in every run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.work import fresh


@dataclass(frozen=True)
class Node:
    """A region or rack (with children) or a shard (``shard`` set, no children)."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    leaf_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.leaf_weight


def balanced_tree(shards: int, shards_per_rack: int = 4, racks_per_region: int = 2) -> Node:
    """Shards ``0..shards-1`` of weight 1, filled rack by rack, region by region."""
    if shards < 1:
        raise ValueError("a tree needs at least one shard")
    racks = [Node(f"rack{r}", tuple(Node(f"shard{s}", shard=s) for s in
                                    range(r * shards_per_rack, min(shards, (r + 1) * shards_per_rack))))
             for r in range(-(-shards // shards_per_rack))]
    regions = [Node(f"region{g}", tuple(racks[g * racks_per_region:(g + 1) * racks_per_region]))
               for g in range(-(-len(racks) // racks_per_region))]
    return Node("root", tuple(regions))


def shard_ids(tree: Node) -> list[int]:
    return [s for c in tree.children for s in shard_ids(c)] if tree.children else [tree.shard]


def grow(tree: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region of its own.

    Only the new region's weight changes at the root, so the new shard takes
    rows and no other row moves. (Added to an existing rack, it would raise that
    rack's and region's weights, and rows drawn into them would spread over all
    their shards.)
    """
    new = max(shard_ids(tree)) + 1
    leaf = Node(f"shard{new}", shard=new, leaf_weight=weight)
    return Node(tree.name, (*tree.children, Node(f"region+{new}", (Node(f"rack+{new}", (leaf,)),))))


def _descend(key: Column, node: Node) -> Column:
    """Shard number chosen below ``node``."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return _descend(key, node.children[0])
    draws = []
    for i, child in enumerate(node.children):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11).cast("double")
        u = (bits + F.lit(1.0)) / F.lit(float(2 ** 53 + 1))
        draws.append(F.struct((-F.ln(u) / F.lit(float(child.weight))).alias("draw"), F.lit(i).alias("i")))
    best = F.least(*draws)["i"]
    out = F.lit(None).cast("int")
    for i, child in enumerate(node.children):
        out = F.when(best == i, _descend(key, child)).otherwise(out)
    return out


def place(key: str | Column, tree: Node) -> Column:
    """Shard of a key (a null key is a key like any other)."""
    return _descend(F.col(key) if isinstance(key, str) else key, tree).cast("int")


def slots(df: DataFrame, shard: str = "shard", order: tuple[str, ...] = (), buckets: int = 256) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within each shard.

    A shard can hold any number of rows, so no task numbers a whole shard: rows
    are numbered within ``(shard, hash bucket)``, and the buckets' first numbers
    come from a table of at most ``shards x buckets`` counts. Buckets are by the
    hash of the whole row, so rows of one key (or of none) do not share one.
    """
    cols = [F.col(f"`{c}`") for c in (order or [c for c in df.columns if c != shard])]
    bucket, n, first = fresh(df, "__bucket", "__n", "__first")
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])  # rows of one key are still dealt over buckets
    b = df.withColumn(bucket, F.pmod(content, F.lit(buckets)).cast("int"))
    counts = b.groupBy(shard, bucket).agg(F.count("*").alias(n))
    w = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(shard, bucket, F.coalesce(F.sum(n).over(w), F.lit(0)).alias(first))
    place = F.row_number().over(Window.partitionBy(shard, bucket).orderBy(*cols, content))
    return (b.withColumn(n, place).join(F.broadcast(before), [shard, bucket])  # <= shards x buckets rows
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col(first) + F.col(n) - 1).cast("long").alias("slot")))


def assign(docs: DataFrame, tree: Node, grown: Node | None = None, key: str = "doc_id",
           buckets: int = 256) -> DataFrame:
    """Shard, slot and (if ``grown`` is given) the shard after growth, per row.

    ``docs``: any columns; all are kept (``shard``, ``slot`` and ``grown_shard``
    of the input are replaced). Nulls: a null key is placed like any other
    value. Repeated rows get the same shard and slots of their own. Empty
    tables give no rows. Rows are ordered into slots by the hash bucket of the row, then by the key.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot", "grown_shard")]
    out = docs.select(*keep, place(key, tree).alias("shard"),
                      (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    return slots(out, "shard", (key,), buckets)


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write rows as Parquet, a folder per shard (several files for a large shard)."""
    (assigned.repartition("shard", F.pmod(F.xxhash64("slot"), F.lit(16)))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
