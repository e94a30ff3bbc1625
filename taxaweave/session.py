"""Session helpers: building a local session for tests/bench and finding the
shared folder that the cluster names for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "taxaweave",
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """A local session with the settings the library expects (tests and bench).

    On a cluster, build the session with the cluster's own settings instead; the
    library only relies on AQE being on and the session time zone being UTC.
    ``checkpoint_dir`` is used only when ``spark.checkpoint.dir`` is unset.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        # the chain has more stages than the 100 generated classes kept by default:
        # every run compiled them anew, and started with cold code
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=512m -XX:-DontCompileHugeMethods")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    event_log = os.environ.get("TAXAWEAVE_EVENT_LOG")
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The cluster's shared folder wins; ``checkpoint_dir`` is only a fallback
    # for sessions where none is configured (tests, local runs).
    sc = spark.sparkContext
    if checkpoint_dir and not spark.conf.get(_CHECKPOINT_KEY, None) and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_dir)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (a static setting) or the context's
    checkpoint folder. Only a local-mode session without either gets a folder
    of its own (tests); a cluster must name one, because an executor-local
    folder does not survive the loss of that executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set; name a shared folder (HDFS/S3/ABFS) for this cluster"
            )
        path = tempfile.mkdtemp(prefix="taxaweave-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain ``os`` calls work in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Queries that run inside delete their shuffle files when they end. Else those
    stay on the executors' disks until the driver's JVM happens to collect its
    garbage, so that a job of many steps holds the shuffles of all of them."""
    before = spark.conf.get(_FREE_KEY, None)
    spark.conf.set(_FREE_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_KEY)
        else:
            spark.conf.set(_FREE_KEY, before)


class _Scratch(threading.local):
    """Scratch tables that this thread wrote inside a plan. Callers that run a whole
    chain delete them when the chain's outputs are written; the others leave them to
    the shared folder's own clean-up, as their lazy result still reads them."""

    def __init__(self):
        self.paths: list[str] = []

    def __len__(self):
        return len(self.paths)

    def __getitem__(self, at):
        return self.paths[at]


_SCRATCH = _Scratch()


def scratch_made(path: str) -> None:
    _SCRATCH.paths.append(path)


def scratch_table(df, name: str, partition_by=()):
    """``df`` written once to the shared folder and read back: it is computed
    once however often the plan uses it, and an executor's loss cannot change
    it. LZ4, as it is read back soon."""
    path = scratch_path(df.sparkSession, name)
    scratch_made(path)
    writer = df.write.mode("overwrite").option("compression", "lz4")
    with shuffles_freed(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    return len(_SCRATCH)


def delete_scratch(spark: SparkSession, since: int = 0, keep=()) -> None:
    """Delete the scratch tables that this thread wrote after ``since`` (a
    scratch_mark()), but those of the names in ``keep``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made, _SCRATCH.paths[since:] = _SCRATCH[since:], []
    for name in made:
        if name.rsplit("/", 1)[-1].rsplit("-", 1)[0] in keep:
            scratch_made(name)
            continue
        path = hadoop.Path(name)
        path.getFileSystem(conf).delete(path, True)
