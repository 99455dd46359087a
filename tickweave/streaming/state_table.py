"""Latest state per key from a stream, kept in a bucketed table and merged batch by batch.

Every micro-batch is reduced to the latest row per key first (one row per task
and key is exchanged); then only the buckets that hold its keys are read,
merged and written again, into a folder of the batch's own id. A small table
says which batch wrote a bucket last. A batch that runs again starts from the
buckets as the batches before it left them, so it writes the same; readers see
a batch when its line in that table is there. No state is held in memory.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

UPDATES = "updates"


def _latest(rows: DataFrame, keys, cols, order, updates) -> DataFrame:
    """Latest row per key by ``order`` (a NULL part is the lowest), and the sum of ``updates``."""
    row = F.max_by(F.struct(*cols), F.struct(*order))
    return (rows.groupBy(*keys).agg(row.alias("__r"), F.sum(updates).cast("long").alias(UPDATES))
            .select(*keys, "__r.*", UPDATES))


def heads(spark: SparkSession, root: str, before: int | None = None) -> dict[int, int]:
    """Bucket -> batch that wrote it last (of batches under ``before``); at most one entry per bucket."""
    try:
        rows = spark.read.schema("bucket int, batch_id long").parquet(f"{root}/heads")
    except AnalysisException:  # nothing landed yet
        return {}
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    return {r["bucket"]: r["at"] for r in rows.groupBy("bucket").agg(F.max("batch_id").alias("at")).collect()}


def _read(spark: SparkSession, root: str, schema: StructType, at: dict[int, int]) -> DataFrame | None:
    paths = [f"{root}/state/batch_id={i}/bucket={b}" for b, i in sorted(at.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def merge_batch(batch: DataFrame, batch_id: int, root: str, keys, order=("ts", "seq"), buckets: int = 64) -> None:
    """Merge one micro-batch into the state table at ``root``.

    ``buckets``: fixed for the life of a table; a merge reads and writes the
    buckets its keys fall in. Keys may be NULL. ``updates`` counts the rows per
    key over all batches. Of rows that tie in ``order`` one is kept.
    """
    spark = batch.sparkSession
    cols = [c for c in batch.columns if c not in keys]
    schema = StructType([*[batch.schema[c] for c in [*keys, *cols]]]).add(UPDATES, LongType())
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = _latest(batch.withColumn("__n", F.lit(1)), keys, cols, order, "__n").persist()  # read for its buckets, and merged
    try:
        touched = [r[0] for r in fresh.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
        earlier = heads(spark, root, before=batch_id)
        old = _read(spark, root, schema, {b: earlier[b] for b in touched if b in earlier})
        new = fresh if old is None else _latest(old.unionByName(fresh), keys, cols, order, UPDATES)
        (new.withColumn("batch_id", F.lit(batch_id)).withColumn("bucket", bucket).repartition("bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "bucket")
         .parquet(f"{root}/state"))
        _commit(spark, root, batch_id, touched)
    finally:
        fresh.unpersist()


def _commit(spark: SparkSession, root: str, batch_id: int, touched: list[int]) -> None:
    lines = spark.createDataFrame([(b, batch_id) for b in touched], "bucket int, batch_id long").coalesce(1)
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/heads")


def maintain(stream: DataFrame, root: str, checkpoint: str, keys, order=("ts", "seq"), buckets: int = 64,
             processing_time: str | None = None) -> StreamingQuery:
    """Keep the state table at ``root`` from a stream; with ``processing_time`` until stopped, else what is there."""
    w = stream.writeStream.foreachBatch(lambda df, i: merge_batch(df, i, root, keys, order, buckets)).option(
        "checkpointLocation", checkpoint)
    return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()


def current(spark: SparkSession, root: str, like: DataFrame, keys) -> DataFrame:
    """The state: one row per key, ``keys``, the other columns of ``like`` (the stream or a table like it), ``updates``."""
    cols = [*keys, *[c for c in like.columns if c not in keys]]
    schema = StructType([like.schema[c] for c in cols]).add(UPDATES, LongType())
    found = _read(spark, root, schema, heads(spark, root))
    return found if found is not None else spark.createDataFrame([], schema)


def drop_old(spark: SparkSession, root: str) -> int:
    """Delete bucket folders that a later batch has replaced; how many. Not while a reader still uses them."""
    at = heads(spark, root)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(f"{root}/state")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = 0
    for folder in fs.globStatus(hadoop.Path(base, "batch_id=*/bucket=*")):
        path = folder.getPath()
        b, i = int(path.getName().split("=")[1]), int(path.getParent().getName().split("=")[1])
        if i < at.get(b, -1):
            dropped += bool(fs.delete(path, True))
    return dropped
