"""Jobs that move data between layers, each one callable."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.references import lacking_reference
from tidewell.operators.upsert import Merged, upsert_path
from tidewell.plans.entities import ENTITIES
from tidewell.plans.entity import REFUSED, EntityPlan
from tidewell.plans.replay import replay_entity
from tidewell.plans.steps import Context
from tidewell.session import COMPRESSION, settling
from tidewell.sources import jdbc
from tidewell.sources.files import load_seed
from tidewell.sources.lake import (
    BUCKET,
    append,
    append_unless_empty,
    data_folders,
    list_folders,
    load_mark,
    overwrite,
    path_exists,
    read_lake,
    read_or_none,
    remember_schema,
    store_mark,
)
from tidewell.sources.ledger import HIDDEN, live_rows
from tidewell.sources.lineage import INGEST_DAY, canonical_lineage, stamp_bronze, stamp_landing
from tidewell.sources.watermark import EPOCH, high_watermark, rows_not_held

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    """How one entity's job ended."""

    entity: str
    status: str
    detail: str = ""
    rows: int | None = None


def run_each(names: Sequence[str], job: Callable[[str], int]) -> list[Outcome]:
    """Run a job, which returns its number of rows, for each name; one failure
    does not stop the others."""
    outcomes = []
    for name in names:
        try:
            done = int(job(name))
            log.info("job for %s: %s rows", name, done)
            outcomes.append(Outcome(name, "loaded" if done else "nothing new", rows=done))
        except Exception as error:  # noqa: BLE001 - reported, not swallowed
            log.exception("job for %s failed", name)
            outcomes.append(Outcome(name, "failed", str(error).splitlines()[0]))
    return outcomes


def outcome_table(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    rows = [(o.entity, o.status, o.detail, o.rows) for o in outcomes]
    return spark.createDataFrame(rows, "entity string, status string, detail string, rows long")


def ingest_days(spark: SparkSession, bronze: str) -> list[date]:
    """The days a bronze table has folders for, found by listing it."""
    folders = [f for root in data_folders(spark, bronze) for f in list_folders(spark, root, f"{INGEST_DAY}=")]
    names = {f.rpartition("=")[2] for f in folders}
    return sorted(date.fromisoformat(n) for n in names if n[:1].isdigit())


def _missing_in_bronze(spark: SparkSession, bronze: str, watermark: str, rows_from: Callable) -> DataFrame:
    """Rows of a source that bronze lacks; ``rows_from`` reads it from a watermark on.

    Of bronze only the last day's folder is read, and that of rows without a stamp.
    """
    table = read_or_none(spark, bronze, evolving=True)
    if table is not None and INGEST_DAY in table.columns:
        days = ingest_days(spark, bronze)
        last = F.col(INGEST_DAY) == F.lit(days[-1]) if days else F.lit(False)
        table = table.filter(last | F.col(INGEST_DAY).isNull())
    mark = high_watermark(table, watermark)
    return rows_not_held(rows_from(mark), table, watermark, mark)


def _append_bronze(spark: SparkSession, rows: DataFrame, bronze: str, watermark: str) -> int:
    """Append in folders per ingest day, so that the next run finds its watermark
    in the last folder alone.  A table kept without such folders stays so."""
    table = read_or_none(spark, bronze, evolving=True)
    if table is not None and INGEST_DAY not in table.columns:
        return append_unless_empty(rows, bronze, widen=True)
    dated = rows.withColumn(INGEST_DAY, F.to_date(watermark))
    return append_unless_empty(dated, bronze, by=[INGEST_DAY], widen=True)


def landing_to_bronze(
    spark: SparkSession, landing: str, bronze: str, watermark: str = "dw_ingested_at"
) -> int:
    """Append the landing rows that bronze lacks, from its watermark on; returns
    their number.  Rows with the stamp of the watermark or with none are compared."""
    landed = live_rows(spark, read_lake(spark, landing, evolving=True), landing).drop(*HIDDEN)
    if path_exists(spark, bronze):
        # types that grew in landing grow here first, so that rows compare as they are
        remember_schema(spark, bronze, landed.schema, widen=True)
    fresh = _missing_in_bronze(spark, bronze, watermark, lambda mark: landed)
    return _append_bronze(spark, fresh, bronze, watermark)


def jdbc_to_bronze(
    spark: SparkSession,
    connection: jdbc.Connection,
    table: str,
    bronze: str,
    batch_id: str,
    watermark: str = "dw_ingested_at",
    slices: jdbc.Slices | None = None,
    at: datetime | None = None,
) -> int:
    """Append the database rows that bronze lacks, from its watermark on, stamped;
    returns their number."""
    fresh = _missing_in_bronze(
        spark,
        bronze,
        watermark,
        lambda mark: jdbc.read_after(spark, connection, table, watermark, mark, slices, inclusive=True),
    )
    return _append_bronze(spark, stamp_bronze(fresh, batch_id, table, at), bronze, watermark)


def copy_table(
    spark: SparkSession,
    source: jdbc.Connection,
    target: jdbc.Connection,
    table: str,
    target_table: str,
    key: Sequence[str],
    batch_id: str,
    column: str = "created_at",
    slices: jdbc.Slices | None = None,
    at: datetime | None = None,
    state: str | None = None,
) -> None:
    """Copy new rows from one database to another.

    Rows from the watermark on are read again and those the target already holds
    are left out by key.  The watermark is the source's highest stamp before the
    last copy that succeeded, kept in the folder ``state``: the target's own
    highest stamp may lie above rows that a broken copy never wrote.  Without
    ``state`` all rows are compared.
    """
    stored = load_mark(spark, state) if state else None
    mark = datetime.fromisoformat(stored) if stored else EPOCH
    reached = jdbc.read_watermark(spark, source, table, column)
    fresh = jdbc.read_after(spark, source, table, column, mark, slices, inclusive=True)
    held = jdbc.read_after(spark, target, target_table, column, mark, slices, inclusive=True)
    missing = lacking_reference(fresh, held, {k: k for k in key})
    jdbc.append_table(stamp_landing(missing, batch_id, at, table), target, target_table)
    if state and reached is not None:
        store_mark(spark, state, reached.isoformat())


def same_values(key: Sequence[str]) -> Column:
    """Whether the columns of a key equal those of the other side, null like any value."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key])


def seed_table(
    spark: SparkSession,
    seed: DataFrame,
    path: str,
    batch_id: str,
    source: str,
    at: datetime | None = None,
    restamp: str = "new",
    key: Sequence[str] = (),
) -> None:
    """Load a seed into a lake table.

    With a ``key`` rows whose key the table holds are left out, so that a seed may be
    loaded again; without one every load adds all its rows.
    """
    table = read_or_none(spark, path)
    if key and table is not None:
        seed = seed.join(table.select(*[F.col(k).alias(f"__{k}") for k in key]), same_values(key), "left_anti")
    if restamp == "new":
        # rows that are there keep their stamps, so the others are only added
        append(load_seed(seed, None, batch_id, source, at, restamp), path)
        return
    loaded = load_seed(seed, table, batch_id, source, at, restamp)
    with settling(spark) as settled:
        # The table may be one of its own inputs.
        overwrite(settled(loaded, "seed"), path)


@dataclass(frozen=True)
class Published:
    """The quality report of a batch and what became of its accepted rows."""

    report: DataFrame
    merged: Merged


def publish(
    spark: SparkSession,
    plan: EntityPlan,
    raw: DataFrame,
    context: Context,
    target: str,
    quarantine: str,
    batch_id: str,
    buckets: int | None = None,
) -> DataFrame:
    """Audit raw rows once, upsert the accepted, store the rejected and return
    the quality report.  Repeating a batch leaves both tables as they are."""
    return publish_accounted(spark, plan, raw, context, target, quarantine, batch_id, buckets).report


def publish_accounted(
    spark: SparkSession,
    plan: EntityPlan,
    raw: DataFrame,
    context: Context,
    target: str,
    quarantine: str,
    batch_id: str,
    buckets: int | None = None,
) -> Published:
    """``publish`` with the merge's own account: every raw row is inserted, updated, a
    repetition of the stored row, or in the quarantine with its reason."""
    with settling(spark) as settled:
        audited = settled(plan.audited(canonical_lineage(raw), context), f"audit-{plan.name}")
        merged = upsert_path(spark, target, plan.accepted(audited), plan.merge_keys, plan.newer_than, buckets, plan.newest, reduced=True)
        rejected = plan.quarantine(audited, batch_id)
        refused = merged.refused_frame(spark, target)
        if refused is not None:
            rejected = rejected.unionByName(plan.refused(refused, batch_id))
        (
            rejected.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(quarantine, compression=COMPRESSION)
        )
        report = plan.report(audited)
        # one row per rule
        counts = {r["measure"]: r["row_count"] for r in report.collect()}
        if merged.refused:
            counts["accepted rows"] -= merged.refused
            counts["rejected rows"] = counts.get("rejected rows", 0) + merged.refused
            counts[REFUSED] = merged.refused
        told = [(plan.name, measure, n) for measure, n in counts.items() if n]
        return Published(spark.createDataFrame(told, report.schema), merged)


def curated_tables(spark: SparkSession, root: str) -> Mapping[str, DataFrame]:
    """The curated tables written so far."""
    found = {}
    for name in ENTITIES:
        path = f"{root}/silver/{name}"
        if path_exists(spark, path):
            found[name] = read_lake(spark, path).drop(BUCKET)
    return found


def rows_since(bronze: DataFrame, day: str | None) -> DataFrame:
    """Bronze rows from an ingest day on; other folders are not read."""
    if day is None or INGEST_DAY not in bronze.columns:
        return bronze
    since = F.col(INGEST_DAY) >= F.lit(date.fromisoformat(day))
    return bronze.filter(since | F.col(INGEST_DAY).isNull())


def curate_all(
    spark: SparkSession,
    root: str,
    batch_id: str,
    as_of=None,
    names: Sequence[str] | None = None,
    buckets: int | None = None,
    whole: bool = False,
) -> list[Outcome]:
    """Publish the entities below ``root`` (bronze/<name> to silver/<name>) in
    the order of their references.

    A run reads bronze from the last ingest day of the run before on, that day
    included, and rows without a stamp; ``whole`` reads all of it.  Quarantined rows whose
    reference has come since are judged again (see ``plans.replay``).
    """

    def one(name: str) -> int:
        bronze, state = f"{root}/bronze/{name}", f"{root}/_curated/{name}"
        raw = read_or_none(spark, bronze, evolving=True)
        if raw is None:
            return 0
        days = ingest_days(spark, bronze) if INGEST_DAY in raw.columns else []
        raw = raw if whole else rows_since(raw, load_mark(spark, state))
        context = Context(curated_tables(spark, root), as_of)
        report = publish(
            spark,
            ENTITIES[name],
            raw,
            context,
            f"{root}/silver/{name}",
            f"{root}/quarantine/{name}",
            batch_id,
            buckets,
        )
        overwrite(report, f"{root}/quality/{name}/batch_id={batch_id}")
        replayed = replay_entity(spark, ENTITIES[name], raw, context, root, batch_id, buckets)
        if replayed.judged:
            log.info("%s: %s quarantined rows judged again, %s stored", name, replayed.judged, replayed.merged.stored)
        if days:
            store_mark(spark, state, days[-1].isoformat())
        return sum(r["row_count"] for r in report.collect() if r["measure"] in ("accepted rows", "rejected rows"))

    return run_each(names or list(ENTITIES), one)
