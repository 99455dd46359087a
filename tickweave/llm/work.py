"""Work tables in the shared checkpoint folder, and small column helpers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.session import delete_work, work_path

# White space of the text contracts: space and the five ASCII control blanks.
BLANK = r"[\x20\x09-\x0D]+"

_HELD: list[DataFrame] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table (columns are pruned by what the caller selects)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rows read and sent to Python at once while work tables are made: texts can be long, and the
# defaults (thousands of rows) would hold tens of MB per task and copy in flight.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.parquet.columnarReaderBatchSize": "512"}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Plan what runs inside with :data:`BATCHES`; the session's own settings come back after."""
    before = {k: spark.conf.get(k) for k in BATCHES}
    try:
        for k, v in BATCHES.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def one_wave(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as the cluster has cores: for small rows that come out of a shuffle."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def cut(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Ends the lineage on storage every executor can read, so a lost executor
    costs a re-read and not a re-run. The plan is run once (``checkpoint()``
    runs it twice). For tables whose numbers must never be drawn again
    (generated ids) and for rounds of a loop, whose plan would else grow with
    every round. Removed by :func:`drop`, or when the driver ends.

    ``few``: written in one wave of tasks (:func:`one_wave`).
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    with small_batches(spark):
        (one_wave(df) if few else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path  # noqa: SLF001  (own marker, read by drop)
    return out


def hold(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it on the executors' disks, for steps that read it more than once.

    The lineage stays: blocks of a lost executor are computed again. Only for
    deterministic plans. Released by :func:`drop` or :func:`release`.
    """
    out = df.persist(StorageLevel.DISK_ONLY)
    with small_batches(df.sparkSession):
        out.count()
    _HELD.append(out)
    return out


def release() -> None:
    """Free all held work tables (``session.clean_up`` frees written ones); write results that read them first."""
    while _HELD:
        _HELD.pop().unpersist()


def drop(*tables: DataFrame) -> None:
    """Free work tables that no later step reads."""
    for t in tables:
        if any(t is h for h in _HELD):
            _HELD[:] = [h for h in _HELD if h is not t]
            t.unpersist()
        delete_work(getattr(t, "_work_path", ""))


def apart(*cols: str) -> Column:
    """A join key derived from join keys, joined beside them.

    The sides of such a join are never already dealt by its keys, so both get
    an exchange of their own, which AQE can split where a key is hot.
    """
    return F.xxhash64(*cols)


ID, TEXT = "__doc_id", "__doc_text"


def whole_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` as one struct ``__row`` beside its id and text, so that no column name can clash with a step's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias(ID),
                       F.col(text_col).alias(TEXT))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (names are the same whatever their case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n in taken:
            n += "_"
        out.append(n)
    return out


def text_bytes(col: str | Column) -> Column:
    """UTF-8 length of a text; none for a null."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def ascii_lower(col: str | Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
