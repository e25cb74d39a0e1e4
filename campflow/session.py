"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_SPLIT = "spark.sql.files.maxPartitionBytes"
#: Interactions take some thirty times their Parquet size as rows. A task sorts its rows by key before it drops copies, so
#: Spark's default of 128 MB a task would mean gigabytes.
_ROWS_SPLIT = 32 << 20
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", app_name: str = "campflow", **conf: str) -> SparkSession:
    """A session for tests and single-machine runs. On a cluster, bring your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the library relies on.

    Times carry no offset, so hours and dates are only stable under a fixed zone. The shuffle width is left
    alone on a cluster (AQE coalesces from whatever the cluster sets); a local run needs no more than its cores.

    HotSpot never compiles a method above 8,000 bytes of bytecode. Wide projections fused into one method pass that
    easily and are then interpreted, several times slower; with the limit set, Spark splits them instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if spark.conf.get(_STATE_STORE).endswith("HDFSBackedStateStoreProvider"):
        # the default keeps all state of a task in heap memory, which ids kept without end outgrow
        spark.conf.set(_STATE_STORE, _ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if to_bytes(spark.conf.get(_SPLIT)) > _ROWS_SPLIT:
        spark.conf.set(_SPLIT, str(_ROWS_SPLIT))
    context = spark.sparkContext
    if context.master.startswith("local"):
        spark.conf.set("spark.sql.shuffle.partitions", str(context.defaultParallelism))
    return spark


_MB = 1024 * 1024
_INPUT_PER_TASK, _MAX_SPLIT = 128 * _MB, 4096 * _MB
_MAX_MAPS, _MAX_REDUCERS = 32_000, 20_000


def shuffle_plan(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a batch that shuffles ``input_bytes`` of files once.

    AQE merges small reduce partitions but splits large ones only in joins, so it has to start from enough of them:
    one per 128 MB. Both sides are bounded, because a shuffle has maps times reducers blocks: above some terabytes
    the splits grow to 4 GB (columnar and pruned, they shuffle far less) and the reduce partitions beyond 128 MB, where
    sorting spills to disk. From there on a shuffle service that merges blocks (push-based shuffle) is needed.
    """
    reducers = min(max(-(-input_bytes // _INPUT_PER_TASK), cores), _MAX_REDUCERS)
    split = min(max(-(-input_bytes // _MAX_MAPS), _INPUT_PER_TASK), _MAX_SPLIT)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(reducers),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def input_bytes(*inputs: DataFrame) -> int:
    """The size of the files that ``inputs`` read, as Spark's reader lists them."""
    sizes = 0
    for df in inputs:
        names = df.inputFiles()
        if names:
            folders = df.sparkSession.read.format("binaryFile").load(names).select("length")
            sizes += folders.agg(F.sum("length")).first()[0] or 0
    return sizes


@contextmanager
def sized_shuffles(*inputs: DataFrame) -> Iterator[None]:
    """Within the block, the session plans shuffles for the files that ``inputs`` read; afterwards as before.

    The settings are the session's: jobs that run at the same time in other threads should have sessions of their own
    (``spark.newSession()``).
    """
    spark = inputs[0].sparkSession
    plan = shuffle_plan(input_bytes(*inputs), spark.sparkContext.defaultParallelism)
    before = {key: spark.conf.get(key, None) for key in plan}
    try:
        for key, value in plan.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder of the cluster, for written tables and stream checkpoints.

    Only a local run may fall back to a temporary folder: on a cluster, executors cannot see the driver's disk.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="campflow-")
