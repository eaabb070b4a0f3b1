"""Which state of which file a landing table holds.

The ledger has one row per file and load: the file's path, when it was last changed
as the load read it, and the load.  It lies beside the data in folders per load, which a repeated
load replaces.  Files whose listed time is newer than the newest in the ledger were
overwritten; their older rows are retired as soon as the ledger knows the newer ones.
All of it is joins over the listing and the ledger: no path comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import remove_path
from tidewell.sources.lake import data_folders, list_folders, path_exists
from tidewell.sources.lineage import FILE_CHANGED, LANDING_LOAD

LEDGER = "_ledger"
# Columns of landing rows that go no further.
HIDDEN = (LANDING_LOAD, FILE_CHANGED)
# Loads that read overwritten files; their rows count once the ledger names them.
AGAIN = "again-"

_PATH, _CHANGED = "path", "changed_at"


def read_ledger(spark: SparkSession, target: str) -> DataFrame | None:
    """path, changed_at, dw_load of every file that was read."""
    store = f"{target}/{LEDGER}"
    if not path_exists(spark, store):
        return None
    return spark.read.schema(f"{_PATH} string, {_CHANGED} timestamp, {LANDING_LOAD} string").parquet(store)


def record(rows: DataFrame, target: str, load: str) -> None:
    """Enter the files of a load's rows, found in what the load has written."""
    files = rows.select(F.col("dw_source_file").alias(_PATH), F.col(FILE_CHANGED).alias(_CHANGED)).distinct()
    files.write.mode("overwrite").parquet(f"{target}/{LEDGER}/{LANDING_LOAD}={load}")


def listed_files(spark: SparkSession, source: str) -> DataFrame:
    """path, changed_at of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return files.select(F.col("_metadata.file_path").alias(_PATH), F.col("_metadata.file_modification_time").alias(_CHANGED))


def overwritten_files(spark: SparkSession, source: str, target: str) -> DataFrame | None:
    """path, changed_at of files that were changed since they were read last."""
    ledger = read_ledger(spark, target)
    if ledger is None:
        return None
    last = ledger.groupBy(_PATH).agg(F.max(_CHANGED).alias("read_at"))
    listed = listed_files(spark, source)
    return listed.join(last, _PATH).filter(F.col(_CHANGED) > F.col("read_at")).select(_PATH, _CHANGED)


def forget_unrecorded(spark: SparkSession, target: str) -> None:
    """Delete what an interrupted load of overwritten files left behind."""
    ledger = f"{target}/{LEDGER}"
    known = {f.rpartition("=")[2] for f in list_folders(spark, ledger, LANDING_LOAD)} if path_exists(spark, ledger) else set()
    for root in data_folders(spark, target):
        for folder in list_folders(spark, root, f"{LANDING_LOAD}={AGAIN}"):
            if folder.rpartition("=")[2] not in known:
                remove_path(spark, folder)


def live_rows(spark: SparkSession, rows: DataFrame, target: str) -> DataFrame:
    """Landing rows of the newest state of their file."""
    ledger = read_ledger(spark, target)
    if ledger is None or LANDING_LOAD not in rows.columns:
        return rows
    # a load may have been entered twice
    ledger = ledger.groupBy(_PATH, LANDING_LOAD).agg(F.max(_CHANGED).alias(_CHANGED))
    last = ledger.groupBy(_PATH).agg(F.max(_CHANGED).alias("last"))
    ledger = ledger.join(last, _PATH)
    live = ledger.select(F.col(_PATH).alias("dw_source_file"), LANDING_LOAD, (F.col(_CHANGED) == F.col("last")).alias("live"))
    joined = rows.join(live, ["dw_source_file", LANDING_LOAD], "left")
    unknown = ~F.startswith(F.col(LANDING_LOAD).cast("string"), F.lit(AGAIN))
    return joined.filter(F.coalesce("live", unknown)).select(*rows.columns)
