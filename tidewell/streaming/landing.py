"""CSV drops into landing tables, as run-to-completion streams."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewell.functions.lattice import read_as
from tidewell.operators.upsert import upsert_path
from tidewell.plans.jobs import Outcome
from tidewell.session import settling
from tidewell.sources.lake import cast_to, data_folder, read_lake, remember_schema
from tidewell.sources.ledger import AGAIN, HIDDEN, LEDGER, forget_unrecorded, live_rows, overwritten_files, record
from tidewell.sources.lineage import FILE_CHANGED, LANDING_LOAD, RESCUED, stamp_landing
from tidewell.streaming.schemas import as_text, current_schema

log = logging.getLogger(__name__)

# The entities dropped as CSV files, and the intake limit.
CSV_ENTITIES = ["users", "subscriptions", "subscription_changes", "payments", "support_tickets"]
FILES_PER_TRIGGER = 500


def csv_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(source)
    )


def json_stream(
    spark: SparkSession, source: str, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """One JSON document per line, kept as text for ``parse_json``."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .text(source)
        .withColumnRenamed("value", "data")
    )


def first_copies(
    stream: DataFrame, key: Sequence[str], event_time: str, delay: str = "1 hour"
) -> DataFrame:
    """Drop repeated business keys that arrive within ``delay`` of each other.

    State older than the delay is given up, so it does not grow with the stream.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def to_table(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append of all available input."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )


def typed_rows(text: DataFrame, schema: StructType) -> DataFrame:
    """Columns of text in the types of a schema; what does not fit is kept in ``dw_rescued``.

    That column holds the values by column as JSON text, and is null for most rows.
    """
    values, misfits = [], []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        value = read_as(column, field.dataType.simpleString())
        values.append(value.alias(field.name))
        misfits.append(F.when(column.isNotNull() & value.isNull(), F.struct(F.lit(field.name).alias("key"), column.alias("value"))))
    rescued = F.filter(F.array(*misfits), lambda m: m.isNotNull())
    kept = [c for c in text.columns if c not in schema.names]
    return text.select(*values, F.when(F.size(rescued) > 0, F.to_json(F.map_from_entries(rescued))).alias(RESCUED), *kept)


def load_to_table(
    stream: DataFrame, target: str, checkpoint: str, copies: bool = False, schema: StructType | None = None
) -> StreamingQuery:
    """Append, without whole-row copies inside a micro-batch unless ``copies``.

    Stamps and file make rows of different files differ, so copies can only
    meet inside one micro-batch: no state is kept.  Each micro-batch owns a
    folder named after query and batch, which a repeated micro-batch replaces.
    Rows that tell when their file was changed are entered in the ledger.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_load(rows if copies else rows.dropDuplicates(), target, f"{query}-{epoch}", schema)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def write_load(rows: DataFrame, target: str, load: str, schema: StructType | None = None) -> None:
    """Write a load into its folder and then into the ledger; a repetition replaces both."""
    spark = rows.sparkSession
    folder = f"{data_folder(spark, target)}/{LANDING_LOAD}={load}"
    (rows if schema is None else cast_to(rows, schema)).write.mode("overwrite").parquet(folder)
    if FILE_CHANGED in rows.columns:
        written = spark.read.schema(f"dw_source_file string, {FILE_CHANGED} timestamp").parquet(folder)
        record(written, target, load)


def distinct_to_table(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append without whole-row copies inside a micro-batch (see ``load_to_table``)."""
    return load_to_table(stream, target, checkpoint)


def upsert_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    newest: Sequence[str],
    newer_than: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch; a repeated micro-batch changes nothing."""

    def merge(rows: DataFrame, epoch: int) -> None:
        upsert_path(rows.sparkSession, target, rows, keys, newer_than, buckets, newest)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )


@dataclass(frozen=True)
class Drop:
    """Where an entity's CSV files arrive and where they land."""

    entity: str
    source: str
    target: str
    checkpoint: str
    schema_store: str

    @classmethod
    def below(cls, root: str, entity: str) -> Drop:
        landing = f"{root}/landing"
        return cls(
            entity,
            f"{root}/raw_files/{entity}",
            f"{landing}/{entity}",
            f"{landing}/_checkpoints/{entity}",
            f"{landing}/_schemas/{entity}",
        )


def landing_rows(text: DataFrame, schema: StructType, batch_id: str, at: datetime | None = None) -> DataFrame:
    """Rows read as text in the types of a schema, stamped, with file and when it was changed."""
    about = text.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_modification_time").alias(FILE_CHANGED))
    return stamp_landing(typed_rows(about, schema), batch_id, at, F.col("__file")).drop("__file")


def start_landing(
    spark: SparkSession,
    drop: Drop,
    batch_id: str,
    at: datetime | None = None,
    copies: bool = False,
    files_per_trigger: int = FILES_PER_TRIGGER,
    widen: bool = True,
) -> StreamingQuery:
    """Start one entity's stream; ``copies`` keeps whole-row copies.

    Types of columns grow with the values of new files; without ``widen`` they stay, and
    values that do not fit are in the column ``dw_rescued``.
    """
    schema = current_schema(spark, drop.source, drop.schema_store, widen)
    stream = csv_stream(spark, drop.source, as_text(schema.names), files_per_trigger)
    stamped = landing_rows(stream, schema, batch_id, at)
    whole = remember_schema(spark, drop.target, stamped.schema, widen=True)
    return load_to_table(stamped, drop.target, drop.checkpoint, copies, whole)


def land_overwritten(
    spark: SparkSession, drop: Drop, batch_id: str, at: datetime | None = None, copies: bool = False, widen: bool = True
) -> int:
    """Read files again that were overwritten under their name; returns how many.

    Their older rows are retired with the load.  An interrupted run leaves the table as
    it was, and a repeated one gives the same.
    """
    changed = overwritten_files(spark, drop.source, drop.target)
    if changed is None:
        return 0
    forget_unrecorded(spark, drop.target)
    with settling(spark) as settled:
        changed = settled(changed, "overwritten")
        found = changed.agg(F.count("*").alias("files"), F.min("changed_at").alias("oldest"), F.max("changed_at").alias("newest")).first()
        if not found["files"]:
            return 0
        schema = current_schema(spark, drop.source, drop.schema_store, widen)
        reader = spark.read.schema(as_text(schema.names)).option("header", True).option("recursiveFileLookup", True)
        since = (found["oldest"] - timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
        rows = landing_rows(reader.option("modifiedAfter", since).csv(drop.source), schema, batch_id, at)
        same = (F.col("dw_source_file") == F.col("path")) & (F.col(FILE_CHANGED) == F.col("changed_at"))
        rows = rows.join(changed, same, "left_semi")
        whole = remember_schema(spark, drop.target, rows.schema, widen=True)
        load = f"{AGAIN}{found['newest'].strftime('%Y%m%dT%H%M%S%f')}"
        write_load(rows if copies else rows.dropDuplicates(), drop.target, load, whole)
        # a file without rows left is known to have been read as well
        empty = changed.withColumn(LANDING_LOAD, F.lit(load)).select("path", "changed_at")
        empty.write.mode("append").parquet(f"{drop.target}/{LEDGER}/{LANDING_LOAD}={load}")
        return found["files"]


def land_all(
    spark: SparkSession,
    drops: Sequence[Drop],
    batch_id: str,
    at: datetime | None = None,
    copies: bool = False,
    widen: bool = True,
) -> list[Outcome]:
    """Start all streams together, then wait for each in turn and read again what was
    overwritten."""
    started: list[tuple[Drop, StreamingQuery | None, str]] = []
    for drop in drops:
        try:
            started.append((drop, start_landing(spark, drop, batch_id, at, copies, widen=widen), ""))
        except Exception as error:  # noqa: BLE001 - reported, not swallowed
            log.exception("stream for %s did not start", drop.entity)
            started.append((drop, None, str(error).splitlines()[0]))
    outcomes = []
    for drop, query, detail in started:
        if query is None:
            outcomes.append(Outcome(drop.entity, "failed", detail))
            continue
        try:
            query.awaitTermination()
            again = land_overwritten(spark, drop, batch_id, at, copies, widen)
            outcomes.append(Outcome(drop.entity, "loaded", f"{again} files read again" if again else ""))
        except Exception as error:  # noqa: BLE001 - reported, not swallowed
            log.exception("stream for %s failed", drop.entity)
            outcomes.append(Outcome(drop.entity, "failed", str(error).splitlines()[0]))
    return outcomes


def read_landing(spark: SparkSession, drop: Drop) -> DataFrame:
    """The rows of the newest state of every file."""
    return live_rows(spark, read_lake(spark, drop.target, evolving=True), drop.target).drop(*HIDDEN)
