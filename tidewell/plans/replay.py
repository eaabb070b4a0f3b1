"""Quarantined rows judged again when the keys they lacked have come.

A replay looks only at rows that were rejected for a missing reference, and of these only
at rows whose key is among the reference rows that arrived since the last replay: the
buckets of the reference that loads have written since then.  A quarantined row keeps its
columns as they left the plan, so just the checks from the first reference on are made
again.  Accepted rows are upserted and leave the quarantine; the others stay with the
reasons they have now.  A replay that was interrupted may be repeated: the upsert finds
its rows again and changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators.quality import envelope, union_all
from tidewell.operators.references import Reference, unique_keys
from tidewell.operators.upsert import Merged, upsert_path
from tidewell.plans.entity import SUPERSEDED, EntityPlan
from tidewell.plans.steps import FAILED, Check, Context, Latest, References, alive, unmarked
from tidewell.session import COMPRESSION, remove_path, settling
from tidewell.sources.lake import BUCKET, current_load, load_mark, path_exists, read_lake, state_at, store_mark
from tidewell.sources.lineage import canonical_lineage

_ROW = "__row"


@dataclass(frozen=True)
class Replayed:
    """How many quarantined rows were judged again, and what became of the accepted."""

    judged: int = 0
    merged: Merged = Merged()


def references_of(plan: EntityPlan) -> list[Reference]:
    return [r for step in plan.steps if isinstance(step, References) for r in step.references]


def _judging(plan: EntityPlan) -> list:
    """The checks from the first reference on, and the choice of one row per key."""
    first = next(n for n, step in enumerate(plan.steps) if isinstance(step, References))
    checks = [s for s in plan.steps[first:] if isinstance(s, (References, Check, Latest))]
    return [*checks, Latest(plan.batch_key or plan.merge_keys, plan.newest, SUPERSEDED)]


def arrived_rows(spark: SparkSession, path: str, version: int | None) -> DataFrame | None:
    """Rows of an upserted table in buckets written since a version; None if there are none.

    They hold every key that came since.  Without the version's state all rows count.
    """
    state = current_load(spark, path)
    if state is None or state.version == version:
        return None
    before = None if version is None else state_at(spark, path, version)
    rows = read_lake(spark, path)
    if before is None:
        return rows.drop(BUCKET)
    changed = [bucket for bucket, load in state.loads.items() if before.loads.get(bucket) != load]
    return rows.filter(F.col(BUCKET).isin(changed)).drop(BUCKET) if changed else None


def _waiting(rows: DataFrame, plan: EntityPlan, arrived: Mapping[str, DataFrame], schema: StructType) -> DataFrame:
    """Quarantined rows that lacked a key which has arrived."""
    references = [r for r in references_of(plan) if r.table in arrived]
    reason = reduce(Column.__or__, [F.col("reason").contains(r.message) for r in references])
    keys = sorted({own for r in references for own in r.on})
    types = StructType([schema[k] for k in keys])
    rows = rows.filter(reason).withColumn("__keys", F.from_json("payload", types))
    hits = []
    for n, reference in enumerate(references):
        own = {f"__{n}_{k}": k for k in reference.on}
        found = arrived[reference.table].select(*[F.col(reference.on[k]).alias(name) for name, k in own.items()])
        found = unique_keys(found).withColumn(f"__hit{n}", F.lit(True))
        same = reduce(Column.__and__, [F.col("__keys")[k] == F.col(name) for name, k in own.items()])
        rows = rows.join(found, same, "left").drop(*own)
        hits.append(F.col(f"__hit{n}").isNotNull() & F.col("reason").contains(reference.message))
    return rows.filter(reduce(Column.__or__, hits)).drop("__keys", *[f"__hit{n}" for n in range(len(hits))])


def _staying(whole: DataFrame, candidates: DataFrame) -> DataFrame:
    """Quarantined rows of the candidates' batches that are no candidates.

    Copies of a candidate are candidates too, so what is unlike them all stays.
    """
    identity = F.unhex(F.sha2(F.to_json(F.struct("batch_id", "reason", "payload")), 256))
    # one row per batch; joined by shuffle a whole batch would be read by one task
    touched = F.broadcast(candidates.select("batch_id").distinct())
    others = whole.join(touched, "batch_id", "left_semi").withColumn("__own", identity)
    # digests are far wider than the compressed rows by which Spark judges their size
    gone = unique_keys(candidates.select(identity.alias("__id"))).hint("merge")
    return others.join(gone, F.col("__own") == F.col("__id"), "left_anti").drop("__own")


def replay(
    spark: SparkSession,
    plan: EntityPlan,
    raw: DataFrame,
    context: Context,
    arrived: Mapping[str, DataFrame],
    target: str,
    quarantine: str,
    batch_id: str,
    buckets: int | None = None,
) -> Replayed:
    """Judge again what waited for the ``arrived`` rows of reference tables by name.

    ``raw`` gives the columns of the entity's raw rows; none of its rows is read.  Accepted
    rows that the stored table refuses go to the quarantine as batch ``replay-<batch_id>``.
    """
    schema = StructType([f for f in plan.audited(canonical_lineage(raw.limit(0)), context).schema if f.name != FAILED])
    with settling(spark) as settled:
        whole = spark.read.parquet(quarantine)
        columns = whole.columns
        about = whole.withColumn("__folder", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", ""))
        candidates = settled(_waiting(about, plan, arrived, schema).withColumn(_ROW, F.monotonically_increasing_id()), "replay")
        if candidates.isEmpty():
            return Replayed()
        rows = candidates.select(_ROW, F.from_json("payload", schema).alias("p")).select(_ROW, "p.*")
        audited = unmarked(rows)
        for step in _judging(plan):
            audited = step.audit(audited, context)
        audited = settled(audited, f"replayed-{plan.name}")
        accepted = plan.accepted(audited.drop(_ROW))
        merged = upsert_path(spark, target, accepted, plan.merge_keys, plan.newer_than, buckets, plan.newest)

        stay = _staying(whole, candidates).select(columns)
        batches = candidates.select(_ROW, F.col("batch_id").alias("__batch"))
        still = audited.filter(~alive()).join(batches, _ROW).drop(_ROW)
        judged = envelope(still, plan.name, FAILED, F.col("__batch"), ["__batch"])
        kept = [stay, judged]
        refused = merged.refused_frame(spark, target)
        if refused is not None:
            kept.append(plan.refused(refused, f"replay-{batch_id}"))
        left = settled(union_all(kept), "quarantine")
        left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine, compression=COMPRESSION)
        # batches of which nothing is left; one row per batch reaches the driver
        empty = candidates.select("batch_id", "__folder").distinct().join(left.select("batch_id").distinct(), "batch_id", "left_anti")
        for row in empty.collect():
            # the file's path is written as a URI
            remove_path(spark, unquote(row["__folder"]))
        return Replayed(candidates.count(), merged)


def replay_entity(spark: SparkSession, plan: EntityPlan, raw: DataFrame, context: Context, root: str, batch_id: str, buckets: int | None = None) -> Replayed:
    """``replay`` below ``root`` with the reference rows that came since the last one."""
    quarantine, mark = f"{root}/quarantine/{plan.name}", f"{root}/_replayed/{plan.name}"
    places = {r.table: f"{root}/silver/{r.table}" for r in references_of(plan)}
    states = {table: current_load(spark, path) for table, path in places.items() if path_exists(spark, path)}
    versions = {table: state.version for table, state in states.items() if state is not None}
    stored = load_mark(spark, mark)
    seen = json.loads(stored) if stored else {}
    done = Replayed()
    if versions != seen and path_exists(spark, quarantine):
        rows = {table: arrived_rows(spark, places[table], seen.get(table)) for table in versions}
        arrived = {table: found for table, found in rows.items() if found is not None}
        if arrived:
            done = replay(spark, plan, raw, context, arrived, f"{root}/silver/{plan.name}", quarantine, batch_id, buckets)
    if versions != seen:
        store_mark(spark, mark, json.dumps(versions))
    return done
