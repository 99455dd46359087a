"""Centroid clustering in exact integers, on bit planes.

A vector of 64 integers is kept as bit planes: bit ``i`` of plane ``j`` is bit
``j`` of component ``i`` in two's complement, so every plane is one 64-bit word
and the last one counts negatively. A dot product is then the sum of
``weight_i * weight_j * popcount(plane_i & plane_j)`` over the planes of a
vector and of a centroid, and squared distances follow from it exactly.

A round is one Spark job: tasks assign their vectors and add up the components
of each cluster; per task at most one row per cluster and component is summed,
and the driver gets one number per cluster and component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.work import cut, drop, one_wave

WIDTH = 64  # components of a vector: one bit of a word each
MOST_PLANES = 28  # beyond, a squared distance could pass 63 bits


def weights(planes: int) -> np.ndarray:
    """What a set bit of each plane stands for (two's complement)."""
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """Rows of 64 integers as rows of ``planes`` words."""
    bits = (x[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpacked_sums(planes: np.ndarray) -> np.ndarray:
    """Componentwise sums of all packed vectors."""
    bits = np.stack([np.unpackbits(np.ascontiguousarray(planes[:, j]).view(np.uint8).reshape(-1, 8), axis=1,
                                   bitorder="little").sum(axis=0, dtype=np.int64) for j in range(planes.shape[1])])
    return weights(planes.shape[1]) @ bits


def dots(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Dot products of packed vectors with one packed vector, by weighted popcounts of ANDed planes."""
    w = weights(planes.shape[1])
    out = np.zeros(len(planes), np.int64)
    for j, plane in enumerate(other):
        out += w[j] * (np.bitwise_count(planes & plane).astype(np.int64) @ w)
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and its squared distance, per packed vector."""
    packed = pack(centroids, planes.shape[1])
    far = np.stack([norms + int(c @ c) - 2 * dots(planes, p) for c, p in zip(centroids, packed)], axis=1)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(far)), best]


def _columns(batch: pa.RecordBatch, planes: int) -> tuple[np.ndarray, np.ndarray]:
    words = batch.column("planes").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return words.view(np.uint64).reshape(-1, planes), batch.column("norm").to_numpy(zero_copy_only=False)


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``id, x``: vectors of exactly 64 components, none null or not finite, as ``floor(scale * component)``."""
    v = F.col(f"`{vec_col}`")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (vectors.select(F.col(f"`{id_col}`").alias("id"), v.cast("array<double>").alias("v"),
                           ((F.size(v) == WIDTH) & fine).alias("fine")).filter("fine")
            .select("id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x")))


def packed(ints: DataFrame) -> tuple[DataFrame, int]:
    """``id, planes, norm`` in a work table, and the number of planes that the widest component needs."""
    low, high = ints.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    planes = 1 + max((abs(v + (v < 0)).bit_length() for v in (low, high) if v is not None), default=1)
    if planes > MOST_PLANES:
        raise ValueError(f"components of {planes} bits: their squared distances do not fit 64 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            words = pack(x, planes).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(words.reshape(-1)), planes).cast(
                    pa.list_(pa.int64())), pa.array((x * x).sum(axis=1))], names=["id", "planes", "norm"])

    kind = ints.schema["id"].dataType.simpleString()
    return cut(ints.mapInArrow(run, f"id {kind}, planes array<long>, norm long"), "planes"), planes


def seeds(rows: DataFrame, planes: int, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors whose ``salt:id`` has the smallest sha256, in that order (null ids last; equal ids by content)."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = rows.select("planes", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "planes").limit(k).collect()
    words = np.array([r["planes"] for r in first], np.int64).reshape(-1, planes).view(np.uint64)
    return np.array([unpacked_sums(w[None, :]) for w in words], np.int64).reshape(-1, WIDTH)


def sums(rows: DataFrame, planes: int, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    """Per (cluster, component) the exact sum over its vectors; component -1 holds their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), WIDTH + 1), np.int64)  # of this task
        for batch in batches:
            words, norms = _columns(batch, planes)
            best, _ = nearest(words, norms, centroids)
            for c in np.unique(best):
                mine = words[best == c]
                total[c, :WIDTH] += unpacked_sums(mine)
                total[c, WIDTH] += len(mine)
        c, at = np.nonzero(total[:, WIDTH:] + np.zeros_like(total))  # clusters that got rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int32)), pa.array(np.where(at == WIDTH, -1, at).astype(np.int32)), pa.array(total[c, at])],
            names=["cluster", "at", "total"])

    parts = rows.select("planes", "norm").mapInArrow(run, "cluster int, at int, total long")
    got = parts.groupBy("cluster", "at").agg(F.sum("total").alias("total")).collect()  # k x 65 numbers
    return {(r["cluster"], r["at"]): r["total"] for r in got}


def move(centroids: np.ndarray, totals: dict[tuple[int, int], int]) -> np.ndarray:
    """Each centroid to the floor of its vectors' mean; one without vectors stays."""
    out = centroids.copy()
    for c in range(len(out)):
        if n := totals.get((c, -1), 0):
            out[c] = [totals[c, i] // n for i in range(WIDTH)]
    return out


def assigned(rows: DataFrame, planes: int, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, far = nearest(*_columns(batch, planes), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best.astype(np.int32)), pa.array(far)],
                                             names=["id", "cluster", "distance"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, salt: str = "3", scale: int = 1024,
            id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Clusters of all usable vectors, and the final centroids.

    Rows: ``id, cluster, distance`` (squared, from the nearest centroid; ties go
    to the smaller number), ``cluster_inertia`` and ``inertia`` (distances
    summed over its cluster and over all). A vector that is null, not of 64
    components, or holds a null, infinite or NaN component takes no part and
    gives no row. Repeated rows count each. With fewer than ``k`` vectors every
    vector is a centroid; an empty table gives no rows. Other columns are not
    read. Components beyond ``2 ** 27`` in size raise an error, as
    their distances do not fit 64 bits.

    Every round reads the packed planes, a work table in the shared folder; a
    lost executor costs its tasks of the round under way.
    """
    rows, planes = packed(integers(vectors, id_col, vec_col, scale))
    centroids = seeds(rows, planes, k, salt)
    if not len(centroids):
        kind = rows.schema["id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long"), centroids
    for _ in range(rounds):
        new = move(centroids, sums(rows, planes, centroids))
        if (new == centroids).all():  # no later round can move them
            break
        centroids = new
    out = cut(one_wave(assigned(rows, planes, centroids)), "clusters")
    drop(rows)
    found = dict(out.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows
    each = F.array(*[F.lit(int(found.get(c, 0))).cast("long") for c in range(len(centroids))])
    return out.select("id", "cluster", "distance", each[F.col("cluster")].alias("cluster_inertia"),
                      F.lit(int(sum(found.values()))).cast("long").alias("inertia")), centroids
