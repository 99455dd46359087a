"""Embedding near-duplicates by spherical-cap filters.

Filter directions are sums of one codeword per block of coordinates, from a
random code per block (after a random rotation): ``size ** blocks`` directions
for ``size * blocks`` dot products; a few such tables, independently drawn, even
out how many directions a vector gets. Each vector is list-decoded to all
directions it exceeds the cap threshold for; vectors of a label that share a
direction are candidates, and candidates are verified by cosine in double
precision. Equal vectors are one class and are decoded and compared once.

Blocks of few coordinates have no scores that far out, so vectors whose blocks
are narrower than ``NARROW`` meet in grid cells instead, which misses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.components import connected
from tickweave.llm.work import apart, cut, hold

CHUNK = 256  # vectors decoded at once
NARROW = 24  # block width from which caps reach their recall
AXES = 5  # coordinates of a grid cell


def codes(dim: int, blocks: int, size: int, seed: int) -> tuple[np.ndarray, list[np.ndarray], list[slice]]:
    """A random rotation, and per block of coordinates ``size`` unit codewords."""
    r = np.random.default_rng([seed, dim])
    turn, _ = np.linalg.qr(r.standard_normal((dim, dim)))
    cuts = np.linspace(0, dim, min(blocks, dim) + 1).astype(int)
    parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
    words = []
    for p in parts:
        c = r.standard_normal((size, p.stop - p.start))
        words.append(c / np.linalg.norm(c, axis=1, keepdims=True))
    return turn, words, parts


def decode(scores: list[np.ndarray], threshold: float) -> list[int]:
    """All codeword combinations (as one number each) whose scores add up to ``threshold``."""
    rest = np.cumsum([s.max() for s in scores][::-1])[::-1]
    sums, ids = np.zeros(1), np.zeros(1, np.int64)
    for i, s in enumerate(scores):
        later = rest[i + 1] if i + 1 < len(scores) else 0.0
        near = np.nonzero(s >= threshold - later - sums.max(initial=-np.inf))[0] if len(sums) else []
        if not len(near):
            return []
        total = sums[:, None] + s[near][None, :]
        a, b = np.nonzero(total >= threshold - later)
        sums, ids = total[a, b], ids[a] * len(s) + near[b]
    return ids.tolist()


def cells(x: np.ndarray, least: float) -> list[int]:
    """Grid cells (as one number each) of a unit vector; vectors at cosine ``least`` or more share one.

    Such vectors are at most ``reach`` apart, so the point halfway is within half
    of that of both: a vector gets the cells its surroundings of that size touch.
    """
    reach = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-6
    width = max(reach, 1e-3)
    most = int(1 / width) + 2
    x = x[:AXES]
    low, high = (np.floor((x + d) / width).astype(int) + most for d in (-reach / 2, reach / 2))
    out = []
    for at in product(*(range(a, b + 1) for a, b in zip(low.tolist(), high.tolist()))):
        n = 0
        for c in at:
            n = n * (2 * most + 1) + c
        out.append(n)
    return out


def unit(raw: np.ndarray) -> np.ndarray | None:
    """The vector at length 1 in double precision; none if it is empty, zero or not finite."""
    x = raw.astype(np.float64)
    if not len(x) or not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cls, vec = [], []
        for label, values in zip(batch.column(1), batch.column(2)):
            v = values.values if values.is_valid and label.is_valid else None
            ok = v is not None and v.null_count == 0
            x = np.ascontiguousarray(v.to_numpy(zero_copy_only=False) + 0.0) if ok else None  # + 0.0: no minus zero
            if x is None or unit(x) is None:
                cls.append(None)
                vec.append(None)
            else:
                raw = x.tobytes()
                cls.append(xxhash.xxh3_128_digest(repr((label.as_py(), x.dtype.str)).encode() + raw))
                vec.append(raw)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cls, pa.binary()),
                                          pa.array(vec, pa.binary())], names=["id", "label", "cls", "vec"])


def _decode(dtype: str, least: float, tables: int, blocks: int, size: int, cap: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[int, list[tuple]] = {}
        for batch in batches:
            nodes, labels = batch.column(0).to_pylist(), batch.column(1)
            vecs = [np.frombuffer(b, dtype) for b in batch.column(2).to_pylist()]
            at, filters = [], []
            for dim in sorted({len(v) for v in vecs}):
                if dim not in books:
                    books[dim] = [codes(dim, blocks, size, seed + t) for t in range(tables)]
                mine = [i for i, v in enumerate(vecs) if len(v) == dim]
                for lo in range(0, len(mine), CHUNK):
                    units = np.stack([unit(vecs[i]) for i in mine[lo:lo + CHUNK]])
                    if dim < NARROW * blocks:
                        for i, x in zip(mine[lo:lo + CHUNK], units @ books[dim][0][0]):
                            got = cells(x, least)
                            at += [i] * len(got)
                            filters += got
                        continue
                    for t, (turn, words, parts) in enumerate(books[dim]):
                        x = units @ turn
                        scores = [x[:, p] @ w.T for p, w in zip(parts, words)]
                        # A block score has standard deviation 1 / sqrt(block width) per unit of length.
                        limit = cap / np.sqrt(parts[0].stop)
                        for row, i in enumerate(mine[lo:lo + CHUNK]):
                            got = decode([s[row] for s in scores], limit)
                            at += [i] * len(got)
                            filters += [g * tables + t for g in got]
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[i] for i in at], pa.int64()), labels.take(pa.array(at, pa.int64())),
                 pa.array([len(vecs[i]) for i in at], pa.int32()), pa.array(filters, pa.int64())],
                names=["node", "label", "dim", "filter"])
    return run


def _verify(dtype: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            a, b = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for lo in range(0, len(a), 4096):  # all of one pair have one dimension
                same = {}
                for i in range(lo, min(len(a), lo + 4096)):
                    same.setdefault(len(a[i]), []).append(i)
                for at in same.values():
                    x, y = (np.frombuffer(b"".join(s[i] for i in at), dtype).reshape(len(at), -1).astype(np.float64)
                            for s in (a, b))
                    x, y = (m / np.abs(m).max(axis=1, keepdims=True) for m in (x, y))
                    cos = np.einsum("ij,ij->i", x, y) / np.sqrt(
                        np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
                    keep[at] = cos >= least
            yield batch.select([0, 1, 2, 3]).filter(pa.array(keep))
    return run


def links(classes: DataFrame, dtype: str, least: float, tables: int, blocks: int, size: int, cap: float,
          seed: int) -> DataFrame:
    """Verified pairs ``(u, v, nu, nv)`` of classes ``(node, label, vec, n)``."""
    kind = classes.schema["label"].dataType.simpleString()
    found = hold(classes.select("node", "label", "vec").mapInArrow(
        _decode(dtype, least, tables, blocks, size, cap, seed), f"node long, label {kind}, dim int, filter long"))
    other = found.withColumnRenamed("node", "v")
    pairs = (found.withColumnRenamed("node", "u").join(other, ["label", "dim", "filter"]).filter("u < v")
             .select("u", "v").distinct())
    one = classes.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("vec").alias("a"))
    two = classes.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("vec").alias("b"))
    return hold(pairs.join(one, "u").join(two, "v").select("u", "v", "nu", "nv", "a", "b")
               .mapInArrow(_verify(dtype, least), "u long, v long, nu long, nv long"))


def near_duplicates(vectors: DataFrame, least: float = 0.93, tables: int = 4, blocks: int = 2, size: int = 1024,
                    cap: float = 3.9, seed: int = 11, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: ``id``, ``n_links``, ``component_id``.

    Vectors are compared if their labels are equal and not null and their
    dimensions are equal; cosine of ``least`` or more links them. Vectors that
    are null, empty, zero, or hold a null or non-finite component, and vectors
    without a label, are linked with nothing. ``component_id`` is the smallest
    id reachable, itself included (ids that are null count last). Rows that
    repeat an id are vectors of their own. Empty tables give no rows.

    With the defaults a vector exceeds about 33 of a million directions (``cap``
    standard deviations); a pair at cosine 0.93 shares 13 of them on average.
    Recall against brute force is tested. Below ``NARROW`` coordinates a block (48
    dimensions) no pair is missed; the grid's cells narrow candidates less the
    more dimensions there are, up to a comparison of all vectors of a label.
    """
    base = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    dtype = "<f4" if base.schema["vec"].dataType.elementType.simpleString() == "float" else "<f8"
    if dtype == "<f8":
        base = base.withColumn("vec", F.col("vec").cast("array<double>"))
    ids, kind = (base.schema[c].dataType.simpleString() for c in ("id", "label"))
    read = hold(base.mapInArrow(_read, f"id {ids}, label {kind}, cls binary, vec binary"))
    classes = cut(read.filter("cls is not null").groupBy("cls", "label").agg(
        F.min("id").alias("first_id"), F.count("*").alias("n"), F.min("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()), "vector_classes", few=True)
    found = links(classes, dtype, least, tables, blocks, size, cap, seed)
    degree = (found.select(F.col("u").alias("node"), F.col("nv").alias("d"))
              .unionByName(found.select(F.col("v").alias("node"), F.col("nu").alias("d")))
              .groupBy("node").agg(F.sum("d").alias("d")))
    named = (classes.select("node", "cls", "first_id", "n").join(connected(found), "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    low = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(low, "component").join(degree, "node", "left").select(
        "cls", apart("cls").alias("apart"), "component_id", (F.col("n") - 1 + F.coalesce("d", F.lit(0))).alias("n_links"))
    return (read.select("id", "cls", apart("cls").alias("apart")).join(of_class, ["cls", "apart"], "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
