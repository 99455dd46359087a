"""Text search by trigram postings.

Every three letters in a row of a row's texts (lower case) are a posting to it.
A needle of three letters or more is looked up by its own trigrams: rows that
have them all are candidates, and only those are read and tested. Postings are
stored by hash bucket of the trigram, rows by hash bucket of their key, so a
look-up reads the buckets of its trigrams and of its candidates.

A row has some twenty postings, so the build deals rows and postings to as
many tasks as there are postings for: what a task holds does not grow with
the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

GRAM = 3
POSTINGS_PER_TASK = 1 << 19  # while an index is built; a task holds them up to three times, some 100 bytes each


@dataclass(frozen=True)
class TextIndex:
    """Where an index lies and what it was built over."""

    path: str
    key: tuple[str, ...]
    texts: tuple[str, ...]
    buckets: int
    schema: StructType  # of the stored rows

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/rows")


def trigrams(text: Column) -> Column:
    """Distinct trigrams of a text in lower case; none for NULL or fewer than three letters."""
    low = F.lower(text)
    at = F.sequence(F.lit(1), F.length(low) - GRAM + 1)
    return F.when(F.length(low) >= GRAM, F.array_distinct(F.transform(at, lambda i: F.substring(low, i, F.lit(GRAM)))))


def needle_grams(needle: str) -> list[str]:
    low = needle.lower()
    return sorted({low[i:i + GRAM] for i in range(len(low) - GRAM + 1)})


def _part(cols, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def build(rows: DataFrame, path: str, key, texts, buckets: int = 64) -> TextIndex:
    """Store ``rows`` and the trigram postings of their ``texts`` under ``path``.

    ``key``: columns that tell rows apart; rows that repeat a key are found
    together and tested each. ``buckets``: folders of either table (about
    table size / 256 MB at scale); a folder has as many files as its size asks for.
    """
    spark = rows.sparkSession
    stored = rows.withColumn("__part", _part(key, buckets))
    # AQE cuts a large folder into several tasks, each of which sorts and writes its own file.
    stored.hint("rebalance", "__part").write.mode("overwrite").partitionBy("__part").parquet(f"{path}/rows")
    index = TextIndex(path, tuple(key), tuple(texts), buckets, stored.schema)
    keys = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)])
    read = index.rows(spark).select(F.col("__part").alias("row_part"), keys.alias("k"),
                                    *[F.col(t).alias(f"t{i}") for i, t in enumerate(texts)])
    tasks = _tasks(read, [f"t{i}" for i in range(len(texts))])
    # Rows are dealt before they are multiplied: by their place, as keys and texts may repeat.
    dealt = read.withColumn("place", F.monotonically_increasing_id()).repartition(tasks, "place")
    parts = [F.coalesce(trigrams(F.col(f"t{i}")), F.array().cast("array<string>")) for i in range(len(texts))]
    grams = parts[0]
    for p in parts[1:]:
        grams = F.array_union(grams, p)
    postings = (dealt.select("row_part", "k", F.explode(grams).alias("gram"))
                .withColumn("bucket", _part(["gram"], buckets)))
    # Sorted by trigram, so that a look-up skips row groups; a hot trigram's bucket is cut by key. Postings of
    # a repeated key lie in one range, so they are made distinct there and not in a table per reading task.
    (postings.repartitionByRange(tasks, "bucket", "gram", "k").distinct().sortWithinPartitions("bucket", "gram")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings"))
    return index


def _tasks(rows: DataFrame, texts) -> int:
    """Tasks for the postings of ``rows``: one per core, or more where they would hold too many."""
    most = sum((F.greatest(F.coalesce(F.length(t), F.lit(0)) - GRAM + 1, F.lit(0)) for t in texts), F.lit(0).cast("long"))
    total = rows.agg(F.sum(most)).first()[0] or 0
    return max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(total / POSTINGS_PER_TASK))


def _contains(index: TextIndex, needle: str) -> Column:
    low = needle.lower()
    found = F.lit(False)
    for t in index.texts:
        found = found | F.coalesce(F.lower(F.col(t)).contains(low), F.lit(False))
    return found


def search(spark: SparkSession, index: TextIndex, needle: str) -> DataFrame:
    """Rows whose texts contain ``needle``, whatever its case: the same rows as a scan, with their own columns.

    A needle under three letters has no trigram and is answered by the scan.
    """
    rows = index.rows(spark)
    grams = needle_grams(needle)
    if grams:
        buckets = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "gram string").select(
            _part(["gram"], index.buckets)).distinct().collect()]
        kind = ", ".join(f"k{i}: {index.schema[c].dataType.simpleString()}" for i, c in enumerate(index.key))
        postings = spark.read.schema(f"row_part int, k struct<{kind}>, gram string, bucket int").parquet(f"{index.path}/postings")
        hits = (postings.where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
                .groupBy("row_part", "k").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)))
        same = F.col("__part") == F.col("row_part")
        for i, c in enumerate(index.key):
            same = same & F.col(c).eqNullSafe(F.col("k")[f"k{i}"])
        rows = rows.join(hits, same, "left_semi")
    return rows.where(_contains(index, needle)).drop("__part")
