"""Best-fit packing in bulk-synchronous rounds.

Documents longer than a sequence are cut into full pieces; what is left of each
document is an item. Items over half a sequence cannot share one, so each opens
a sequence and leaves a gap. Then, in rounds:

1. items and gaps are range-sorted by size into one order, dealt over all tasks;
2. a sweep in ascending order gives each gap the largest waiting item that fits,
   and again for what is left of the gap. Tasks sweep their ranges on their own;
   items and gaps that a range leaves over are matched across ranges, one to one,
   from two counts per range, by their rank;
3. matched gaps shrink, the rest stay; items larger than every gap open as many
   new sequences as their tokens fill.

No task sees more than a range; the driver sees two counts per range and the
number of items and gaps of each size (at most two per token of a sequence).
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import tokens
from tickweave.llm.work import cut, hold, one_wave

ITEM, GAP = 0, 1
BUCKETS = 4096  # hash buckets by which items of one size are told apart when only some open a sequence


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for batch in batches:
            rows, ids = ([], [], [], [], []), []
            for at, text in enumerate(batch.column(1)):
                got = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                n = -(-len(got) // capacity)
                start, stop = 0, len(got) - capacity * (n - 1)
                for piece in range(n):
                    body = got[start:stop]
                    for c, x in zip(rows, (at, piece, start, len(body), zlib.crc32(body.tobytes()))):
                        c.append(x)
                    if with_ids:
                        ids.append(body.astype(np.int32))
                    start, stop = stop, stop + capacity
            cols = [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                    pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: ``id, piece, start, length, ids_crc32`` (and ``ids``).

    A null text is empty (one piece, the end id). Only documents of more than
    ``capacity`` ids are cut; their first piece takes the odd tokens. Rows that
    repeat an id give pieces of their own.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(
        _pieces(path or tokens.vocabulary_path(), capacity, end_id, with_ids),
        f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


SWEPT = "part int, rank long, uid long, size int, bin long, gap int, gaps long, items long"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match items and gaps of one range, in ascending order of size.

    A gap takes the largest item that waits and fits, then the largest that
    fits what is left, and so on. Rows out: a match (item ``uid`` and ``size``,
    its ``bin`` and the gap before); the rest of a gap that took items (``uid``
    and ``rank`` null); an item left over (``bin`` null, ``rank`` in order of
    size); a gap that took none (``uid`` null, ``rank`` in order); and, last,
    how many ``gaps`` and ``items`` the range leaves over.
    """
    part = TaskContext.get().partitionId()
    schema = pa.schema([("part", pa.int32()), ("rank", pa.int64()), ("uid", pa.int64()), ("size", pa.int32()),
                        ("bin", pa.int64()), ("gap", pa.int32()), ("gaps", pa.int64()), ("items", pa.int64())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    sizes: list[int] = []  # of the items that wait, ascending
    waiting: list[int] = []
    lone = 0
    for batch in batches:
        out = []
        for uid, size, kind in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if kind == ITEM:
                sizes.append(size)
                waiting.append(uid)
            elif sizes:
                left = size
                while left and (at := bisect_right(sizes, left) - 1) >= 0:
                    taken, item = sizes.pop(at), waiting.pop(at)
                    out.append((part, None, item, taken, uid, left, None, None))
                    left -= taken
                if left:  # what is left of the gap waits for the next round
                    out.append((part, None, None, None, uid, left, None, None))
            else:
                out.append((part, lone, None, None, uid, size, None, None))
                lone += 1
        if out:
            yield rows(out)
    for i in range(0, len(sizes), 10_000):
        yield rows([(part, i + j, uid, size, None, None, None, None)
                    for j, (uid, size) in enumerate(zip(waiting[i:i + 10_000], sizes[i:i + 10_000]))])
    if lone or sizes:
        yield rows([(part, None, None, None, None, None, lone, len(sizes))])


def _across(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Matches between ranges, from ``(part, gaps left, items left)`` per range.

    Gives ``(item part, highest item rank, gap part, lowest gap rank, number)``:
    a range's free gaps come before its free items, and take the top of the
    stack of what earlier ranges left.
    """
    stack: list[list[int]] = []
    out = []
    for part, gaps, items in sorted(counts):
        at = 0
        while at < gaps and stack:
            n = min(gaps - at, stack[-1][1])
            out.append((stack[-1][0], stack[-1][1] - 1, part, at, n))
            at += n
            stack[-1][1] -= n
            if not stack[-1][1]:
                stack.pop()
        if items:
            stack.append([part, items])
    return out


def _round(pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One sweep: what it placed (``uid, size, bin, gap`` before), and the pool after it."""
    spark = pool.sparkSession
    ranged = (pool.repartitionByRange("size", "kind", "spread").sortWithinPartitions("size", "kind", "spread")
              .select("uid", "size", "kind"))
    swept = cut(ranged.mapInArrow(_sweep, SWEPT), "swept", few=True)
    free = swept.filter("rank is not null")
    counts = swept.filter("gaps is not null").select("part", "gaps", "items").collect()  # a row per range
    matches = _across([tuple(r) for r in counts])  # at most two per range
    placed = swept.filter("rank is null and uid is not null").select("uid", "size", "bin", "gap")
    rests = swept.filter("rank is null and uid is null and bin is not null").select("bin", "gap")
    if matches:
        runs, first = [], 0
        for ip, ir, gp, gr, n in matches:
            runs += [(ip, True, ir - n + 1, ir, first + ir, -1), (gp, False, gr, gr + n - 1, first - gr, 1)]
            first += n
        table = F.broadcast(spark.createDataFrame(
            runs, "of int, item boolean, low long, high long, base long, way int"))
        met = hold(free.join(
            table, (F.col("part") == F.col("of")) & (F.col("uid").isNotNull() == F.col("item"))
            & F.col("rank").between(F.col("low"), F.col("high")), "left")
            .select("uid", "size", "bin", "gap", (F.col("base") + F.col("way") * F.col("rank")).alias("match")))
        pairs = hold(one_wave(met.filter("match is not null").groupBy("match").agg(
            F.max("uid").alias("uid"), F.max("size").alias("size"), F.max("bin").alias("bin"), F.max("gap").alias("gap"))
            .select("uid", "size", "bin", "gap")))
        placed = placed.unionByName(pairs)
        rests = rests.unionByName(pairs.filter("gap > size").select("bin", (F.col("gap") - F.col("size")).alias("gap")))
        free = met.filter("match is null")
    pool = (rests.select(F.col("bin").alias("uid"), F.col("gap").alias("size"), F.lit(GAP).alias("kind"))
            .unionByName(free.select(F.coalesce("uid", "bin").alias("uid"), F.coalesce("size", "gap").alias("size"),
                                     F.when(F.col("uid").isNull(), GAP).otherwise(ITEM).alias("kind"))))
    return placed, pool


def _spread(pool: DataFrame) -> DataFrame:
    return pool.withColumn("spread", F.xxhash64("uid"))


def place(items: DataFrame, capacity: int = 1024) -> DataFrame:
    """``(uid, sequence_id, offset)`` for items ``(uid long, size int)`` of at most ``capacity`` tokens.

    A sequence is named by the item that opened it. Sizes are 1 or more and
    ``uid`` is unique. Items of one size, however many, are dealt over ranges by
    a hash of ``uid``.
    """
    big = F.col("size") > capacity // 2
    opens = items.filter(big)
    done = [opens.select("uid", F.col("uid").alias("sequence_id"), F.lit(0).alias("offset"))]
    pool = items.filter(~big).select("uid", "size", F.lit(ITEM).alias("kind")).unionByName(
        opens.filter(F.col("size") < capacity).select("uid", (capacity - F.col("size")).alias("size"),
                                                      F.lit(GAP).alias("kind")))
    while True:
        rows = pool.groupBy("kind", "size").agg(F.count("*").alias("n")).collect()  # at most 2 x capacity
        waiting = {r["size"]: r["n"] for r in rows if r["kind"] == ITEM}
        gaps = [r["size"] for r in rows if r["kind"] == GAP]
        if not waiting:
            break
        stuck = {s: n for s, n in waiting.items() if s > max(gaps, default=0)}
        if stuck:
            chosen = (F.col("kind") == ITEM) & _opening(pool, stuck, capacity)
            opening = hold(one_wave(pool.filter(chosen)))
            done.append(opening.select("uid", F.col("uid").alias("sequence_id"), F.lit(0).alias("offset")))
            pool = (pool.filter(~chosen)
                    .unionByName(opening.select("uid", (capacity - F.col("size")).alias("size"),
                                                F.lit(GAP).alias("kind"))))
        placed, pool = _round(_spread(pool.filter((F.col("kind") == ITEM) | (F.col("size") >= min(waiting)))))
        done.append(placed.select("uid", F.col("bin").alias("sequence_id"), (capacity - F.col("gap")).alias("offset")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _opening(pool: DataFrame, stuck: dict[int, int], capacity: int):
    """Which stuck items open a sequence: the largest, as many as the tokens of all stuck items fill."""
    need = max(1, -(-sum(s * n for s, n in stuck.items()) // capacity))
    for size in sorted(stuck, reverse=True):
        if need >= stuck[size]:
            need -= stuck[size]
            last, share = size, None
            if not need:
                break
        else:
            last, share = size, need
            break
    if share is None:
        return F.col("size") >= last
    bucket = F.shiftrightunsigned(F.xxhash64("uid"), 52)
    rows = (pool.filter((F.col("kind") == ITEM) & (F.col("size") == last)).groupBy(bucket.alias("b"))
            .agg(F.count("*").alias("n")).collect())  # at most BUCKETS
    upto = 0
    for r in sorted(rows, key=lambda r: r["b"]):
        upto, share = r["b"], share - r["n"]
        if share <= 0:
            break
    return (F.col("size") > last) | ((F.col("size") == last) & (bucket <= upto))


def pack(docs: DataFrame, path: str | None = None, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """:func:`pieces` with ``sequence_id`` and ``offset``, packed into as few sequences as best fit finds.

    Every row of ``docs`` is packed; empty tables give no rows; columns other
    than the id and the text are not read. See :func:`pieces` for nulls and
    repeated rows.
    """
    cutting = cut(pieces(docs, path, capacity, end_id, id_col, text_col, with_ids)
                  .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    items = cutting.select("uid", F.col("length").cast("int").alias("size"))
    big = F.col("length") > capacity // 2
    placed = place(items, capacity)
    return (cutting.filter(big).withColumn("sequence_id", F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
            .unionByName(cutting.filter(~big).join(
                placed.select("uid", "sequence_id", F.col("offset").cast("long").alias("offset")), "uid"))
            .drop("uid"))


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of a packing made ``with_ids``; a sequence is at most ``capacity`` ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"))
