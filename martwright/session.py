"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here relies on. Shuffle width is left to the cluster and AQE, which merges
# partitions up to 16 MB of compressed rows: with sums of several levels in one task they grow fortyfold in memory.
# forceOptimizeSkewedJoin lets AQE split a hot join key even where the next
# aggregation could otherwise have reused the join's partitioning.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Settings that only a new session can take. Python call sites in error messages cost several
# driver round trips per column expression.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def get_session(app_name: str = "martwright", conf: dict[str, str] | None = None) -> SparkSession:
    """One session helper for every job; credentials and endpoints stay in spark-defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**START_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def estimated_bytes(df: DataFrame) -> int:
    """Bytes of the scans below ``df``, by Spark's own estimate: file sizes for stored tables.

    The scans, not the whole plan: for a join without statistics Spark multiplies the sizes of both sides. Inputs of
    unknown size (RDDs), which Spark takes for endless, do not count.
    """
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < unknown)


WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# From this many partitions on they may grow to 16 times the size, so that the blocks of a shuffle stay countable.
MANY = 10_000


def fitted_width(spark: SparkSession, size: int, bytes_per_partition: int) -> int:
    """Partitions for a shuffle over ``size`` bytes of scans, at least as many as the session asks for."""
    narrow, wide = size // bytes_per_partition + 1, size // (16 * bytes_per_partition) + 1
    return max(min(narrow, MANY), wide, int(spark.conf.get("spark.sql.shuffle.partitions")))


def widen_shuffles(spark: SparkSession, size: int, bytes_per_partition: int = 4 * 1024**2) -> None:
    """From here on, start the session's shuffles wide enough for ``size`` bytes of raw scans, which rows of a fact exceed many times."""
    spark.conf.set(WIDTH, str(fitted_width(spark, size, bytes_per_partition)))


@contextmanager
def fitted_shuffles(*inputs: DataFrame, bytes_per_partition: int = 16 * 1024**2) -> Iterator[int]:
    """Inside the block, start shuffles wide enough for the given scans; AQE then merges what turns out small.

    AQE never widens a shuffle, so at 100 TB the default of 200 partitions would put 500 GB
    into each. The file sizes are known from the listing; nothing is read. The session's own setting
    comes back afterwards, so one load does not decide the width of the next.
    """
    spark = inputs[0].sparkSession
    before = spark.conf.get(WIDTH, None)
    size = sum(estimated_bytes(df) for df in inputs)
    width = fitted_width(spark, size, bytes_per_partition)
    spark.conf.set(WIDTH, str(width))
    try:
        yield width
    finally:
        if before is None:
            spark.conf.unset(WIDTH)
        else:
            spark.conf.set(WIDTH, before)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martwright-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# tables that the running load has written for itself
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block give their shuffle files back when they end, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside the block are deleted at its end; only stored tables may be read after it."""
    paths: list[str] = []
    outer = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(outer)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    scratch = _SCRATCH.get()
    if scratch is not None:
        scratch.append(path)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
