"""Session settings and the shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lakecare", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` wins. A machine-local folder is made only for a local
    master, where driver and executors share one disk.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lakecare-", dir="/tmp")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


#: Paths handed out inside the innermost ``owned_scratch`` block.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_folder(spark)}/lakecare-scratch/{name}-{uuid.uuid4().hex}"
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block, however it ends, all that was staged inside it.

    Results that are to outlive the block must be written or collected within it.
    """
    token = _OWNED.set(paths := [])
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            delete_path(spark, path)


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams; the caller's settings stay as they are.

    The number of state partitions is fixed for the life of a checkpoint, so it follows
    the cores of the cluster rather than the batch default. State lives in RocksDB, off
    the heap, which also suits states larger than executor memory.
    """
    sibling = spark.newSession()
    for key, value in spark.sparkContext.getConf().getAll():
        if key.startswith("spark.sql.") and sibling.conf.isModifiable(key):
            sibling.conf.set(key, value)
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sibling.conf.set("spark.sql.shuffle.partitions", state_partitions or spark.sparkContext.defaultParallelism)
    sibling.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return sibling


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: same rows and row placement on every later use."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


#: Setting by which a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that is started in the block as soon as it ends.

    Otherwise they stay until the driver happens to collect its garbage, and a job of many writes
    holds the shuffles of all of them at once. Meant for writes, which run their plan once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back, so that later uses prune columns."""
    path = scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
