"""Keyed upserts: newer rows update, unknown keys insert, the rest stays."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.dedup import latest
from tidewell.session import COMPRESSION, remove_path, settling
from tidewell.sources.lake import (
    BUCKET,
    LOAD,
    SCHEMA_FOLDER,
    Loaded,
    commit_load,
    current_load,
    drop_old_states,
    list_folders,
    load_schema,
    path_exists,
    read_lake,
    remember_schema,
)

DEFAULT_BUCKETS = 64
REFUSED_BUCKET = -1


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])


def _wins(newer_than: str | None) -> Column:
    """Whether a matched source row replaces the target row.  A null stamp on
    either side keeps the target."""
    if newer_than is None:
        return F.lit(True)
    return F.coalesce(F.col(f"s.{newer_than}") > F.col(f"t.{newer_than}"), F.lit(False))


def _pick(column: str, from_source: Column) -> Column:
    return F.when(from_source, F.col(f"s.{column}")).otherwise(F.col(f"t.{column}")).alias(column)


def merge_frames(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    newer_than: str | None = None,
) -> DataFrame:
    """The target after the batch, which must hold each key once.

    ``newer_than`` names the stamp that has to grow for an update; without it
    every match updates.  Rows with a null key match nothing: those of the
    target stay and those of the batch are inserted.  Columns that only one
    side has are kept; where the batch lacks one, an update leaves it as it is.

    Both sides are read once and meet in a full outer join.
    """
    columns, held, joined, in_target, in_batch = _met(target, batch, keys)
    from_source = ~in_target | (in_batch & _wins(newer_than))
    return joined.select(*[F.col(f"t.{c}").alias(c) if c in held else _pick(c, from_source) for c in columns])


def _met(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> tuple[list[str], set[str], DataFrame, Column, Column]:
    """All columns, those of the target alone, both sides joined, and where a row is from."""
    columns = [*target.columns, *[c for c in batch.columns if c not in target.columns]]
    held = set(target.columns) - set(batch.columns)
    target = target.select(*columns_or_null(target, batch, columns))
    batch = batch.select(*columns_or_null(batch, target, columns))
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])

    def prepared(df: DataFrame, side: str) -> DataFrame:
        # Rows without a key match nothing; spread them instead of shuffling
        # all of them to one task.
        lane = F.when(no_key, F.spark_partition_id()).otherwise(F.lit(0))
        return df.withColumns({"__lane": lane, "__here": F.lit(True)}).alias(side)

    joined = prepared(target, "t").join(
        prepared(batch, "s"),
        _same_key(keys) & (F.col("t.__lane") == F.col("s.__lane")),
        "full_outer",
    )
    return columns, held, joined, F.col("t.__here").isNotNull(), F.col("s.__here").isNotNull()


# What became of a batch row.  A refused row is not newer than the stored one and unlike it.
INSERTED, UPDATED, REPEATED, REFUSED = "inserted", "updated", "repeated", "refused"
_OUTCOME = "__outcome"


def merge_accounted(target: DataFrame, batch: DataFrame, keys: Sequence[str], newer_than: str | None = None) -> DataFrame:
    """``merge_frames``, and every refused batch row besides, from the same join.

    ``__outcome`` tells what became of the batch row that a row comes from or met; it is
    null for other rows of the target.  Refused rows are not part of the table.
    """
    columns, held, joined, in_target, in_batch = _met(target, batch, keys)
    wins = in_batch & _wins(newer_than)
    from_source = ~in_target | wins
    shared = [f for f in batch.schema.fields if f.name not in held and f.name in target.columns]
    same = reduce(Column.__and__, [_equal(f"t.{f.name}", f"s.{f.name}", f.dataType.simpleString()) for f in shared])
    refused = in_target & in_batch & ~wins & ~same
    told = F.when(~in_target, INSERTED).when(wins, UPDATED).when(in_batch & ~refused, REPEATED)
    stored = [F.col(f"t.{c}").alias(c) if c in held else _pick(c, from_source) for c in columns]
    lost = [F.lit(None).cast(target.schema[c].dataType).alias(c) if c in held else F.col(f"s.{c}").alias(c) for c in columns]
    row, other = F.struct(*stored, told.alias(_OUTCOME)), F.struct(*lost, F.lit(REFUSED).alias(_OUTCOME))
    return joined.select(F.inline(F.when(refused, F.array(row, other)).otherwise(F.array(row))))


def _equal(one: str, two: str, kind: str) -> Column:
    if "map<" in kind or "variant" in kind:
        return F.to_json(F.struct(one)).eqNullSafe(F.to_json(F.struct(two)))
    return F.col(one).eqNullSafe(F.col(two))


@dataclass(frozen=True)
class Merged:
    """What became of the rows of a batch after one row per key was chosen."""

    inserted: int = 0
    updated: int = 0
    repeated: int = 0
    refused: int = 0
    # where the refused rows are until the table is vacuumed
    refused_rows: str | None = None

    @property
    def stored(self) -> int:
        return self.inserted + self.updated + self.repeated

    def refused_frame(self, spark: SparkSession, path: str) -> DataFrame | None:
        if not self.refused:
            return None
        return spark.read.schema(load_schema(spark, f"{path}/{SCHEMA_FOLDER}")).parquet(self.refused_rows).drop(BUCKET)


def columns_or_null(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns in order; those only the other frame has are null, of its type."""
    own = set(df.columns)
    return [F.col(c) if c in own else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns]


def reduce_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per merge key, as ``merge_frames`` needs it; rows without a key all stay."""
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    lane = F.when(no_key, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return latest(batch.withColumn("__lane", lane), [*keys, "__lane"], order).drop("__lane")


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert_path(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    newer_than: str | None = None,
    buckets: int | None = None,
    newest: Sequence[str] | None = None,
    reduced: bool = False,
) -> Merged:
    """Upsert into a parquet table kept in hash buckets of the merge key.

    The batch may repeat keys: the row highest in ``newest`` (``newer_than``
    unless given) counts, and ``reduced`` says that none is repeated
    and that the batch is stored rows, which need not be written again.  New columns of the batch are added to the table.  The
    number of buckets is kept with the table; 64 for a new one, and another one
    is refused (see ``rebucket``).

    Only the buckets that the batch touches are merged.  Their rows are written
    once, to a folder of this load, and one small file then names the folder of
    every bucket: readers see the table before or after the load, never between,
    and a load that was interrupted has changed nothing and may be repeated.

    With a catalog that has row-level operations use ``merge_into`` instead.

    Returns what became of the batch's rows, counted by the write itself; refused rows
    are written with the load, in a bucket that no reader of the table looks at.
    """
    table = current_load(spark, path)
    if table is None and path_exists(spark, path) and load_schema(spark, f"{path}/{SCHEMA_FOLDER}") is None:
        raise ValueError(f"{path} holds no table of upsert_path")
    count = buckets or (table.buckets if table else DEFAULT_BUCKETS)
    if table is not None and (count, list(keys)) != (table.buckets, list(table.keys)):
        raise ValueError(f"{path} has {table.buckets} buckets of {table.keys}, not {count} of {list(keys)}")
    order = list(newest) if newest is not None else [newer_than] if newer_than else []
    with settling(spark) as settled:
        if reduced:
            rows = with_bucket(batch, keys, count)
        else:
            rows = settled(with_bucket(reduce_batch(batch, keys, order), keys, count), "upsert-batch")
        # Bucket numbers only, so never more than ``buckets`` of them.
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
        remember_schema(spark, path, rows.schema, new=table is None)
        if not touched:
            if table is None:
                commit_load(spark, path, Loaded(0, count, list(keys), {}))
            return Merged()
        merged = rows.withColumn(_OUTCOME, F.lit(INSERTED))
        if table is not None:
            target = read_lake(spark, path).filter(F.col(BUCKET).isin(touched))
            merged = merge_accounted(target, rows, [*keys], newer_than)
        return _commit_rows(spark, path, merged, touched, table or Loaded(0, count, list(keys), {}))


def _commit_rows(spark: SparkSession, path: str, rows: DataFrame, touched: Sequence[int], table: Loaded) -> Merged:
    load = uuid.uuid4().hex
    seen, kinds = Observation(f"merge-{load}"), [INSERTED, UPDATED, REPEATED, REFUSED]
    rows = rows.observe(seen, *[F.count_if(F.coalesce(F.col(_OUTCOME) == kind, F.lit(False))).alias(kind) for kind in kinds])
    bucket = F.when(F.col(_OUTCOME) == REFUSED, F.lit(REFUSED_BUCKET)).otherwise(F.col(BUCKET))
    rows = rows.withColumn(BUCKET, bucket).drop(_OUTCOME)
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{LOAD}={load}", compression=COMPRESSION)
    commit_load(spark, path, table.after({bucket: load for bucket in touched}))
    return Merged(*[seen.get[kind] for kind in kinds], refused_rows=f"{path}/{LOAD}={load}/{BUCKET}={REFUSED_BUCKET}")


def rebucket(spark: SparkSession, path: str, buckets: int) -> None:
    """Write the table anew in another number of buckets."""
    table = current_load(spark, path)
    rows = with_bucket(read_lake(spark, path).drop(BUCKET), table.keys, buckets)
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    _commit_rows(spark, path, rows.withColumn(_OUTCOME, F.lit(None).cast("string")), touched, Loaded(table.version, buckets, table.keys, {}))


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of loads that the table no longer names; returns how many.

    Readers that began before the last load may still need them.
    """
    named = set(current_load(spark, path).loads.values())
    stale = [f for f in list_folders(spark, path, f"{LOAD}=") if f.rpartition("=")[2] not in named]
    for folder in stale:
        remove_path(spark, folder)
    drop_old_states(spark, path)
    return len(stale)


def merge_into(
    batch: DataFrame, table: str, keys: Sequence[str], newer_than: str | None = None
) -> None:
    """The same upsert as one MERGE, for a table whose catalog supports it."""
    on = reduce(Column.__and__, [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys])
    newer = None
    if newer_than is not None:
        newer = F.col(f"source.{newer_than}") > F.col(f"{table}.{newer_than}")
    source = batch.alias("source").mergeInto(table, on)
    matched = source.whenMatched(newer) if newer is not None else source.whenMatched()
    matched.updateAll().whenNotMatched().insertAll().merge()
