"""Session settings and the shared scratch folder the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.  They are applied by
# ``configure`` so that results do not depend on who built the session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Shuffles start with this many partitions; AQE merges those that turn out small.
INITIAL_PARTITIONS = "8192"

# What jobs write: staged rows, upserted tables and quarantines.
COMPRESSION = "zstd"


def build_session(
    app_name: str = "tidewell",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session with the settings the library is tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    fixed = {
        **RUNTIME_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": INITIAL_PARTITIONS,
        # With that many partitions map tasks report mean block sizes only; large
        # blocks must still be told, or AQE would not see a hot key.
        "spark.shuffle.accurateBlockSkewedFactor": "5.0",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        # Building plans of many columns is several times faster without the
        # call site of every expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**fixed, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder on this machine is used only for a local master where none is set.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidewell-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{scratch_root(spark).rstrip('/')}/tidewell/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a plan once to the shared folder and go on from there, so that its
    several outputs neither repeat it nor depend on the executors that ran it."""
    return _written(df, scratch_path(df.sparkSession, label))


def _written(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on any Hadoop file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settling(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``settle`` for the length of a job, which deletes its folders at the end.

    Frames made from them must have been written by then.
    """
    paths: list[str] = []

    def settled(df: DataFrame, label: str) -> DataFrame:
        paths.append(scratch_path(spark, label))
        return _written(df, paths[-1], COMPRESSION)

    try:
        yield settled
    finally:
        for path in paths:
            remove_path(spark, path)
