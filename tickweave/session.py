"""Session helpers: recommended settings and the shared work folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Settings of sessions built here (on a cluster: of spark-submit). Time is kept in
# UTC; the exchange zone is only applied for display (labels), never for grouping.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on local disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", app: str = "tickweave",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass settings through spark-submit instead."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Set the one setting results depend on, the UTC session zone; all others stay the caller's."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system the operator reads from the
    session. Only when nothing is configured (local runs and tests) a private
    folder is created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store): "
                               "jobs write checkpoints and work tables there")
        root = tempfile.mkdtemp(prefix="tickweave-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


_WORK: dict[str, SparkSession] = {}
_TABLES: dict[str, SparkSession] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job output.

    Results read it lazily, so it is kept until :func:`clean_up`, or until the
    driver ends.
    """
    path = f"{checkpoint_root(spark)}/tickweave/{name}-{uuid.uuid4().hex[:12]}"
    _WORK[path] = spark
    return path


def work_table(spark: SparkSession, name: str) -> str:
    """A fresh name for a catalog table, dropped by :func:`clean_up`."""
    name = f"{name}_{uuid.uuid4().hex[:12]}"
    _TABLES[name] = spark
    return name


def is_kept(path: str) -> bool:
    """Whether a work folder is still there."""
    return path in _WORK


def source_version(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files at ``path``: changes when they do."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listStatus(p)
    return ";".join(sorted(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}" for f in files))


def delete_work(path: str) -> None:
    """Delete one work folder now."""
    spark = _WORK.pop(path, None)
    if spark is None or spark.sparkContext._jsc is None:
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clean_up() -> None:
    """Drop all work tables and delete all work folders; results that still read them must have been written."""
    for name, spark in list(_TABLES.items()):
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        del _TABLES[name]
    for path in list(_WORK):
        delete_work(path)


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Py4JError, OSError):  # the JVM may be gone already
        clean_up()
