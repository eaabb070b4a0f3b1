"""Referential checks between a large table and the keys of another.

Joins carry no broadcast hint: Spark broadcasts a reference only below its
size threshold and otherwise sort-merges, where AQE splits the partitions of a
hot key.  Every frame joined here is an exchange away from its source, which
is what AQE needs for that split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of the checked table -> columns of the reference.
KeyMap = Mapping[str, str]


def _renamed_keys(reference: DataFrame, on: KeyMap, suffix: str = "__ref") -> DataFrame:
    return reference.select(*[F.col(ref).alias(f"{own}{suffix}") for own, ref in on.items()])


def _match(on: KeyMap, suffix: str = "__ref") -> Column:
    return reduce(Column.__and__, [F.col(own) == F.col(f"{own}{suffix}") for own in on])


def unique_keys(keys: DataFrame) -> DataFrame:
    """Distinct keys, grouped together with a lane derived from them.

    The lane makes the following join lay out the keys in its own exchange, so
    that AQE still sees plain shuffle stages on both sides and can split a hot
    key of the other side.
    """
    lane = F.pmod(F.xxhash64(*keys.columns), F.lit(1 << 20))
    return keys.withColumn("__lane", lane).distinct().drop("__lane")


def having_reference(df: DataFrame, reference: DataFrame, on: KeyMap) -> DataFrame:
    """Rows whose key exists in the reference; columns keep their order."""
    return df.join(_renamed_keys(reference, on), _match(on), "left_semi")


def lacking_reference(df: DataFrame, reference: DataFrame, on: KeyMap) -> DataFrame:
    """Rows whose key is null or does not exist in the reference."""
    return df.join(_renamed_keys(reference, on), _match(on), "left_anti")


def reference_split(
    df: DataFrame, reference: DataFrame, on: KeyMap, reason: str, column: str = "quarantine_reason"
) -> tuple[DataFrame, DataFrame]:
    orphans = lacking_reference(df, reference, on).withColumn(column, F.lit(reason))
    return having_reference(df, reference, on), orphans


@dataclass(frozen=True)
class Reference:
    """A key of a table that must exist in another.

    ``optional`` lets a null key pass.
    """

    table: str
    on: KeyMap
    message: str
    optional: bool = False

    def nullable_key(self) -> Column:
        return reduce(Column.__or__, [F.col(own).isNull() for own in self.on])


def mark_reference(df: DataFrame, reference: DataFrame, spec: Reference, flag: str) -> DataFrame:
    """Add a flag that is true where the key is missing from the reference.

    One pass for both sides of the split; repeated reference keys never
    multiply rows.
    """
    keys = unique_keys(_renamed_keys(reference, spec.on))
    marked = df.join(keys.withColumn("__found", F.lit(True)), _match(spec.on), "left")
    missing = F.col("__found").isNull()
    if spec.optional:
        missing = missing & ~spec.nullable_key()
    return marked.withColumn(flag, missing).drop("__found", *[f"{own}__ref" for own in spec.on])


def referenced(df: DataFrame, reference: DataFrame, spec: Reference) -> DataFrame:
    """Rows that satisfy the reference, an optional null key included."""
    if not spec.optional:
        return having_reference(df, reference, spec.on)
    flagged = mark_reference(df, reference, spec, "__missing")
    return flagged.filter(~F.col("__missing")).drop("__missing")


def with_roles(df: DataFrame, dimension: DataFrame, key: str, roles: Sequence[str]) -> DataFrame:
    """Rows for which every role column names an existing dimension key."""
    return reduce(lambda kept, role: having_reference(kept, dimension, {role: key}), roles, df)


def without_roles(df: DataFrame, dimension: DataFrame, key: str, roles: Sequence[str]) -> DataFrame:
    """The complement of ``with_roles``; rows with nulls are on this side once."""
    flags = [f"__missing_{role}" for role in roles]
    marked = df
    for role, flag in zip(roles, flags):
        marked = mark_reference(marked, dimension, Reference("", {role: key}, ""), flag)
    any_missing = reduce(Column.__or__, [F.col(f) for f in flags])
    return marked.filter(any_missing).drop(*flags)


def looked_up(
    df: DataFrame, dimension: DataFrame, on: KeyMap, columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Bring columns of a dimension that holds each key once to the rows."""
    keys = [F.col(ref).alias(f"{own}__ref") for own, ref in on.items()]
    return df.join(dimension.select(*keys, *columns), _match(on), how).drop(
        *[f"{own}__ref" for own in on]
    )
