"""Session helpers: building a local session for tests/bench and a shared staging folder.

On a cluster the session is created by the platform; this module only reads its settings. The
staging folder is the cluster's ``spark.checkpoint.dir`` (a shared, reliable file system). A
folder of our own is created only when that setting is missing and Spark runs in local mode.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Generated methods above 8000 bytes of bytecode are never JIT-compiled by HotSpot; the silver
    # stage fuses ~40 column expressions, so let such stages fall back to per-operator codegen.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Building a plan of ~40 wide expressions makes thousands of Python->JVM calls; recording the
    # Python call site of each one for error messages doubles that count.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "roomledger", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local runs that lack it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) first")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="roomledger-ckpt-"))
    return sc.getCheckpointDir()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for a materialised intermediate table."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/staged/{name}-{uuid.uuid4().hex}"
    if _WORK:
        _WORK[-1].append(path)
    return path


_WORK: list[list[str]] = []  # staged paths of the open ``workspace`` blocks


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Staged tables made inside the block are removed at its end, also after an error.

    For jobs that write their result before the block ends; a frame that reads a staged table
    cannot be used afterwards.
    """
    _WORK.append([])
    try:
        yield
    finally:
        for path in _WORK.pop():
            remove(spark, path)


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` lives on."""
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    This cuts the lineage (a lost executor re-reads files instead of recomputing upstream) and,
    unlike an RDD checkpoint, keeps column pruning and filter pushdown for every later reader.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that has fewer splits than the session's shuffle parallelism.

    A small table stored as one row group is read by one task, which would then run every later
    per-row step alone. Large inputs have far more splits than that, so for them this is a no-op
    and adds no shuffle; for small ones the shuffle is cheap and buys all cores.

    Hash-partitioning on ``keys`` (rather than round-robin, which Spark sorts first to make it
    retry-safe) keeps the shuffle cheap. Counting the scan's splits only plans it; nothing runs.
    """
    target = default_parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)
