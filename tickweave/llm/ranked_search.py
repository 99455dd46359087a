"""Ranked lexical search, accumulator-limited and term at a time.

One pass over the texts keeps, per document, its length and how often each term
of the query set occurs (a work table, dealt by documents). An item's terms are
then taken rarest first. Each term has a bound, its largest contribution to any
document. After some terms the ``k``-th best partial score over all documents is
known from a job over the work table; once the bounds of the remaining terms
together stay below it, no document without an accumulator can reach the top,
and the item creates no more. Accumulators that can still reach the top survive
and are updated exactly with the remaining terms.

Items are taken in blocks of a bounded number of bytes; what a block holds
(its terms, their document counts and bounds) is all that the driver sees.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.work import cut, drop

BLOCK_BYTES = 16 << 20  # bytes of item texts (and 64 for each item) in a block
SLICE = 4 << 20  # bytes of a long text whose words are listed at once

# Letters A-Z lower-cased, digits, letters and all that is not ASCII kept, the rest a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a list for each slice of it."""
    text = text.translate(FOLD)
    start = 0
    while len(text) - start > SLICE:
        stop = text.find(b" ", start + SLICE)
        if stop < 0:
            break
        yield text[start:stop].split()
        start = stop
    yield text[start:].split()


def occurrences(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs``: a document's number of terms, and how often it holds which term of ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found, tfs = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                counts: Counter[bytes] = Counter()
                for words in terms(text.as_py() or b""):
                    counts.update(words)
                hits = sorted((vocabulary[w], counts[w]) for w in vocabulary.keys() & counts.keys())
                n.append(counts.total())
                found.append([t for t, _ in hits])
                tfs.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], names=["id", "n", "terms", "tfs"])

    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, n long, terms array<int>, tfs array<long>")


@dataclass
class Postings:
    """A batch of documents by term: documents and contributions of term ``t`` are at ``at[t]:at[t + 1]``."""

    at: np.ndarray
    docs: np.ndarray
    gains: np.ndarray
    size: int

    def add(self, scores: np.ndarray, t: int, alive: np.ndarray | None = None) -> None:
        """Add a term's contributions to the scores (of documents ``alive`` only)."""
        part = slice(self.at[t], self.at[t + 1])
        docs, gains = self.docs[part], self.gains[part]
        if alive is not None:
            there = alive[docs]
            docs, gains = docs[there], gains[there]
        scores[docs] += gains


def postings(batch: pa.RecordBatch, weights: np.ndarray, docs: int, words: int) -> Postings:
    """``weights`` are the terms' weights; ``docs`` and ``words`` the corpus's number of documents and terms."""
    lists = batch.column("terms")
    found = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tfs = batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    m = 100 - 50 + (50 * n * docs) // max(1, words)
    gains = weights[found] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[owner]))
    order = np.argsort(found, kind="stable")
    return Postings(np.searchsorted(found[order], np.arange(len(weights) + 1)), owner[order], gains[order], batch.num_rows)


@dataclass
class Item:
    """An item's terms, rarest first, with the bounds of what comes after each (``rest[j]``: of terms ``j`` and later)."""

    terms: list[int]
    rest: list[int]
    cost: list[int]  # postings of the first ``j`` terms
    stop: int = 0  # terms that may create accumulators
    kth: int = 0  # the k-th best partial score after ``stop`` terms: none of the final top is below it
    open: bool = True

    def forward(self, growth: float) -> None:
        """The next number of terms to look at: where the bounds allow a stop at all, then by growing postings."""
        j = self.stop + 1
        while j < len(self.terms) and (self.rest[0] - self.rest[j] <= self.rest[j]
                                       or self.cost[j] < growth * self.cost[self.stop]):
            j += 1
        self.stop = min(j, len(self.terms))
        self.open = self.stop < len(self.terms)


def _per_term(rows: DataFrame, size: int, of) -> DataFrame:
    """``t, df, bound`` per term: sums and maxima of what ``of`` gives for each batch, one row per task and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            of(batch, df, best)
        t = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(df[t]), pa.array(best[t])],
                                         names=["t", "df", "bound"])

    parts = rows.select("n", "terms", "tfs").mapInArrow(run, "t int, df long, bound long")
    return parts.groupBy("t").agg(F.sum("df").alias("df"), F.max("bound").alias("bound"))


def _kth_partial(rows: DataFrame, items: dict[int, Item], k: int, weights: np.ndarray, docs: int, words: int) -> dict[int, int]:
    """The ``k``-th best partial score of each item over all documents, after its first ``stop`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: np.zeros(0, np.int64) for i in items}
        for batch in batches:
            p = postings(batch, weights, docs, words)
            for i, item in items.items():
                s = np.zeros(p.size, np.int64)
                for t in item.terms[:item.stop]:
                    p.add(s, t)
                s = np.concatenate([best[i], s[s > max(0, item.kth - 1)]])  # the k-th only rises
                best[i] = s if len(s) <= k else np.partition(s, -k)[-k:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(list(best), np.int32), [len(s) for s in best.values()])),
             pa.array(np.concatenate([*best.values(), np.zeros(0, np.int64)]))], names=["item", "score"])

    tops = rows.select("n", "terms", "tfs").mapInArrow(run, "item int, score long")  # at most k per task and item
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    got = tops.withColumn("rank", rank).filter(F.col("rank") <= k).filter(F.col("rank") == k)
    return {r["item"]: r["score"] for r in got.select("item", "score").collect()}  # one number per item


def _finish(rows: DataFrame, items: dict[int, Item], k: int, weights: np.ndarray, docs: int, words: int) -> DataFrame:
    """``item, id, score`` of documents that may be among an item's ``k`` best, scores exact; all of the best are there."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: np.zeros(0, np.int64) for i in items}  # of this task, so far
        for batch in batches:
            p = postings(batch, weights, docs, words)
            ids = batch.column("id")
            by_id = np.empty(p.size, np.int64)
            by_id[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(p.size)
            who, at, scores = [], [], []
            for i, item in items.items():
                s = np.zeros(p.size, np.int64)
                for t in item.terms[:item.stop]:
                    p.add(s, t)
                alive = (s > 0) & (s + item.rest[item.stop] >= item.kth)
                for t in item.terms[item.stop:]:
                    p.add(s, t, alive)
                least = best[i].min() if len(best[i]) == k else 1
                there = np.nonzero(alive & (s >= max(1, least, item.kth)))[0]
                if len(there) > k:
                    there = there[np.lexsort((by_id[there], -s[there]))[:k]]
                both = np.concatenate([best[i], s[there]])
                best[i] = both if len(both) <= k else np.partition(both, -k)[-k:]
                who.append(np.full(len(there), i, np.int32))
                at.append(there)
                scores.append(s[there])
            if who:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(who)), ids.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(scores))],
                    names=["item", "id", "score"])

    return rows.mapInArrow(run, f"item int, id {kind}, score long")


def _block(docs: DataFrame, texts: list[bytes], k: int, growth: float, id_col: str, text_col: str) -> DataFrame:
    """``item, rank, id, score`` of the items numbered as in ``texts``."""
    sets = [sorted({w for words in terms(t) for w in words}) for t in texts]
    vocabulary = {w: t for t, w in enumerate(sorted({w for s in sets for w in s}))}
    rows = cut(occurrences(docs, vocabulary, id_col, text_col), "occurrences")
    n, words = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = len(vocabulary)

    def count(batch: pa.RecordBatch, df: np.ndarray, best: np.ndarray) -> None:
        df += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)

    def largest(batch: pa.RecordBatch, df: np.ndarray, best: np.ndarray) -> None:
        p = postings(batch, weights, n, words)
        df += np.diff(p.at)
        there = np.nonzero(np.diff(p.at))[0]
        best[there] = np.maximum(best[there], np.maximum.reduceat(p.gains, p.at[there]) if len(there) else 0)

    dfs = {r["t"]: r["df"] for r in _per_term(rows, size, count).collect()}  # the block's terms
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * dfs[t] + 1))) if t in dfs else 0
                        for t in range(size)], np.int64)
    bounds = {r["t"]: r["bound"] for r in _per_term(rows, size, largest).collect()}
    items = {}
    for i, s in enumerate(sets):
        ts = sorted((t for t in map(vocabulary.get, s) if t in dfs), key=lambda t: (dfs[t], t))
        if ts:
            rest, cost = [0], [0]
            for t in reversed(ts):
                rest.append(rest[-1] + bounds[t])
            for t in ts:
                cost.append(cost[-1] + dfs[t])
            items[i] = Item(ts, rest[::-1], cost)
            items[i].forward(growth)
    while unsure := {i: x for i, x in items.items() if x.open}:
        kth = _kth_partial(rows, unsure, k, weights, n, words)
        for i, item in unsure.items():
            item.kth = max(item.kth, kth.get(i, 0))
            if item.rest[item.stop] < item.kth:
                item.open = False
            else:
                item.forward(growth)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    out = (_finish(rows, items, k, weights, n, words).withColumn("rank", F.row_number().over(order))
           .filter(F.col("rank") <= k))
    out = cut(out.select("item", "rank", "id", "score"), "ranked", few=True)
    drop(rows)
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 50, growth: float = 2.0, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item, rank, id, score``: each item's ``k`` best documents with a score above 0, best first, ties by id.

    Every row of ``items`` is an item of its own, also where ids repeat or are
    null; an item whose text is null or has no terms gives no rows. Documents
    with a null or empty text are never found and do not count. Null ids come
    last among equal scores; repeated documents are ranked each. Other columns
    are not read, so their names do not matter. Empty tables give no rows.

    ``growth``: how many times more postings an item looks at before it tests
    again whether it may stop creating accumulators. Each block of items
    (``block_bytes`` of text) reads the documents once. What a task keeps
    is one batch of documents and ``k`` numbers per item; jobs give at most
    ``k`` rows per batch and item to the ranking.
    """
    spark = docs.sparkSession
    queries = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    size = queries.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = -(-size // block_bytes)
    kinds = queries.schema["item"].dataType.simpleString(), docs.select(f"`{id_col}`").schema[0].dataType.simpleString()
    out = spark.createDataFrame([], f"item {kinds[0]}, rank int, id {kinds[1]}, score long")
    for b in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()  # bounded by the block
        found = _block(docs, [bytes(r["text"] or b"") for r in part], k, growth, id_col, text_col)
        names = spark.createDataFrame(list(enumerate(r["item"] for r in part)), f"number int, name {kinds[0]}")
        ranked = found.join(names, found["item"] == names["number"]).select(F.col("name").alias("item"), "rank", "id", "score")
        out = ranked if b == 0 else out.unionByName(ranked)
    return out
