"""MinHash near-duplicates: universal hash minima, banding, verification, components.

1. One pass hashes every text: its distinct word shingles, a 128-bit hash of
   its word sequence (equal sequences form one class), and ``bands * rows``
   minima under universal hash functions.
2. Classes that share a band meet in a bucket. Buckets are never expanded into
   pairs: their members are compared with one pivot, verified by signature and
   then on full shingle sets, and links are contracted to components. Where
   members of other components than the pivot's are left, the members of all
   buckets of that pivot are dealt into blocks of bounded size, and each pair of
   blocks is one task's work: it counts the shingles that its texts share (a
   product of small matrices) and returns only links that join components.
3. Components by large-star / small-star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.components import connected
from tickweave.llm.shingles import WordHashes, shingle_set, words_of
from tickweave.llm.work import ID, TEXT, apart, cut, drop, hold, whole_rows

BLOCK = 2048  # shingles hashed at once
BLOCK_ROWS = 256  # texts of a block, on average
COLUMNS = 8192  # shingles counted at once


def _coefficients(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return (r.integers(1, 2 ** 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 2 ** 63, k, dtype=np.uint64))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least 32-bit value of each multiply-add-shift hash function over a set."""
    x = (shingles >> np.uint64(32))[:, None]
    low = np.full(len(a), 0xFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), BLOCK):
            low = np.minimum(low, ((x[i:i + BLOCK] * a + b) >> np.uint64(32)).min(axis=0))
    return low.astype("<u4")


def _sign(width: int, k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coefficients(k, seed)
        cache = WordHashes()
        for batch in batches:
            n, cls, sig = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                s = shingle_set(words, width, cache)
                n.append(len(s))
                cls.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                sig.append(signature(s, a, b).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(sig, pa.binary())], names=["id", "carry", "n", "cls", "sig"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            nodes, sets = [], []
            for node, cls, text in zip(*(batch.column(i) for i in range(3))):
                words = words_of(text.as_py())
                if xxhash.xxh3_128_digest(b" ".join(words)) == cls.as_py():  # else another text of the same id
                    nodes.append(node.as_py())
                    sets.append(shingle_set(words, width, cache).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["node", "shingles"])
    return run


def _similar(threshold_pct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                small = min(len(a), len(b))
                if 100 * small < threshold_pct * max(len(a), len(b)):  # the sizes alone rule it out
                    keep.append(False)
                    continue
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * both >= threshold_pct * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _agree(k: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, k) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= least))
    return run


def _with(pairs: DataFrame, values: DataFrame, col: str) -> DataFrame:
    """Pairs ``(u, v)`` with ``col`` of both ends."""
    return (pairs.join(values.select(F.col("node").alias("u"), F.col(col).alias("a")), "u")
            .join(values.select(F.col("node").alias("v"), F.col(col).alias("b")), "v")
            .select("u", "v", "a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    threshold_pct: int = 80, bands: int = 20, rows: int = 4, margin: float = 0.2,
                    seed: int = 7, carry: dict[str, F.Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n`` (distinct shingles), ``component_id``, ``leader``, and ``carry``.

    Links texts with ``100 * intersection >= threshold_pct * union`` of their
    word-shingle sets (confirmed on full sets). A pair at the threshold shares
    no band with probability ``(1 - s ** rows) ** bands`` (3e-5 at 0.8, 4e-7 at
    0.85); the signature check before it drops pairs whose agreement is
    ``margin`` below the threshold (over four standard deviations).

    ``component_id`` is the smallest id reachable over links and equal texts;
    ``leader`` marks rows whose word sequence is that id's. Texts without words
    (null, empty, blanks) have ``n`` 0, are linked with nothing and lead. A null id is never a component's id unless all its
    ids are null. Rows that repeat an id are rows of their own. Other columns
    of ``docs`` are not read; empty tables give no rows.
    """
    k = bands * rows
    carry = carry or {}
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.struct(F.xxhash64(text_col).alias("_"), *[c.alias(n) for n, c in carry.items()]).alias("carry"))
    signed = hold(base.mapInArrow(_sign(width, k, seed), base.select("id", "carry").schema.add("n", "long")
                                  .add("cls", "binary").add("sig", "binary")))
    # A class is fetched again by the id and text hash of one of its rows, so rows that share an id stay apart.
    low = F.min(F.struct(F.col("id").isNull(), F.col("id").alias("id"), F.col("carry._").alias("text")))
    classes = cut(signed.filter("cls is not null").groupBy("cls").agg(low.alias("low"), F.min("sig").alias("sig"))
                  .select("cls", F.col("low.id").alias("first_id"), F.col("low.text").alias("first_text"), "sig",
                          F.monotonically_increasing_id().alias("node")), "classes", few=True)
    labels = _labels(base, classes, width, threshold_pct, bands, rows, margin)
    named = classes.select("node", "cls", "first_id").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    # The leading class: the one with the smallest id (nulls last), of equal ids the smallest hash.
    ids = named.groupBy("component").agg(F.min(F.struct(
        F.col("first_id").isNull().alias("last"), F.col("first_id").alias("id"), F.col("cls").alias("cls"))).alias("low"))
    of_class = named.join(ids, "component").select(
        "cls", apart("cls").alias("apart"), F.col("low.id").alias("component_id"),
        (F.col("cls") == F.col("low.cls")).alias("leader"))
    return (signed.drop("sig").withColumn("apart", apart("cls")).join(of_class, ["cls", "apart"], "left")
            .select("id", "n", F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
                    .alias("component_id"), F.coalesce("leader", F.lit(True)).alias("leader"),
                    *[F.col(f"carry.{c}").alias(c) for c in carry]))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with its smallest id; options as above.

    Texts without words all stay. Rows that repeat both id and text stay or go
    together (exact dedup tells them apart).
    """
    whole, key = whole_rows(docs, id_col, text_col), F.xxhash64(TEXT)
    rows = near_duplicates(whole, ID, TEXT, carry={"key": key}, **options)
    stay = rows.filter(F.col("leader") & F.col("id").eqNullSafe(F.col("component_id"))).select("id", "key")
    return whole.join(stay, F.col(ID).eqNullSafe(F.col("id")) & (key == F.col("key")), "left_semi").select("__row.*")


def _labels(base: DataFrame, classes: DataFrame, width: int, threshold_pct: int, bands: int, rows: int,
            margin: float) -> DataFrame:
    """``(node, component)`` of the classes that have a link."""
    k, step = bands * rows, 4 * rows
    banded = classes.select("node", F.posexplode(F.array(*[
        F.xxhash64(F.lit(b), F.substring("sig", b * step + 1, step)) for b in range(bands)])).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = hold(_meet(banded.select("node", "bucket"), shared))
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))  # high where many neighbours meet
    wanted = classes.select("node", "cls", "first_id", "first_text").join(weight, "node", "left_semi")
    found = (base.join(wanted, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("carry._") == F.col("first_text")))
             .select("node", "cls", "text").mapInArrow(_sets(width), "node long, shingles binary"))
    sets = hold(found)
    if sets.count() > weight.count():  # rows that repeat both id and text: one set of each
        once = hold(sets.dropDuplicates(["node"]))
        drop(sets)
        sets = once
    sigs = classes.select("node", "sig")
    open_ = members.select("bucket", "node").join(weight, "node")
    pivots = open_.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("top"))
    pivots = pivots.select("bucket", (-F.col("top.minus")).alias("pivot"))
    faced = hold(_meet(open_, pivots).filter("node <> pivot").select("node", "pivot").distinct())
    pairs = faced.select(F.col("node").alias("u"), F.col("pivot").alias("v"))
    likely = _with(pairs, sigs, "sig").mapInArrow(_agree(k, int(k * (threshold_pct / 100 - margin))), "u long, v long")
    links = cut(_with(likely, sets, "shingles").mapInArrow(_similar(threshold_pct), "u long, v long"), "links",
                few=True)
    labels = hold(connected(links))
    more = cut(_block_links(faced, labels, sets, threshold_pct), "block_links", few=True)
    return labels if more.isEmpty() else connected(links.unionByName(more))


def _block_links(faced: DataFrame, labels: DataFrame, sets: DataFrame, threshold_pct: int,
                 block: int = BLOCK_ROWS) -> DataFrame:
    """Links ``(u, v)`` between components among the members that share a pivot, for pivots not joined to them all."""
    near = labels.select(F.col("node").alias("n"), F.col("component").alias("l"))
    met = hold(faced.join(near.select(F.col("n").alias("node"), F.col("l").alias("c")), "node", "left")
               .join(near.select(F.col("n").alias("pivot"), F.col("l").alias("p")), "pivot", "left")
               .select("node", "pivot", F.coalesce("c", "node").alias("component"),
                       (F.coalesce("c", "node") == F.coalesce("p", "pivot")).alias("joined")))
    groups = met.groupBy("pivot").agg(F.count("*").alias("n"), F.min("joined").alias("all"),
                                      F.min("component").alias("lo"), F.max("component").alias("hi"))
    groups = groups.filter("not all and lo < hi").select(
        "pivot", F.ceil(F.col("n") / block).cast("int").alias("blocks"), apart("pivot").alias("apart"))
    dealt = (met.withColumn("apart", apart("pivot")).join(groups, ["pivot", "apart"])
             .withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("pivot", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
                     "node", "component"))
    return (dealt.join(sets, "node").groupBy("pivot", "i", "j")
            .applyInArrow(_compare(threshold_pct), "u long, v long"))


def _compare(threshold_pct: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        node, comp, mine, i, j = (group.column(c).to_numpy() for c in ("node", "component", "mine", "i", "j"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles").combine_chunks()]
        size = np.array([len(x) for x in sets])
        words, at = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), size)
        shared = np.bincount(at, minlength=len(words)) > 1
        place = np.cumsum(shared) - 1
        row, at = row[shared[at]], place[at[shared[at]]]
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        for lo in range(0, int(shared.sum()), COLUMNS):
            a, b = np.searchsorted(at, (lo, lo + COLUMNS))
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[row[a:b], at[a:b] - lo] = 1
            both += part @ part.T
        link = 100 * both >= threshold_pct * (size[:, None] + size[None, :] - both)
        link &= comp[:, None] != comp[None, :]
        if len(node) and i[0] != j[0]:
            link &= mine[:, None] != mine[None, :]  # pairs within a block are its own task's work
        parent = {int(c): int(c) for c in comp}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for a, b in np.argwhere(np.triu(link, 1)).tolist():
            x, y = find(int(comp[a])), find(int(comp[b]))
            if x != y:
                parent[x] = y
                out.append((int(node[a]), int(node[b])))
        return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([x for _, x in out], pa.int64())})
    return run


def _meet(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Members with what is known of their bucket; members of a hot bucket can be split."""
    return (members.withColumn("apart", apart("bucket"))
            .join(buckets.withColumn("apart", apart("bucket")), ["bucket", "apart"]).drop("apart"))
