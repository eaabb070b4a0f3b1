"""Steps of an entity plan.

Each step has two readings.  ``keep`` passes on only the rows that survive, for
plans that want the curated rows alone: rejected rows leave the flow as early
as possible.  ``audit`` passes on every row and records in ``FAILED`` why a row
was rejected, so that curated rows, quarantine and report come from one pass.
A rejected row is not looked at by later steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.casting import typed_columns, typed_select
from tidewell.operators.dedup import latest, mark_latest
from tidewell.operators.quality import Rule, broken, valid_rows
from tidewell.operators.references import Reference, mark_reference, referenced

FAILED = "_failed"


@dataclass(frozen=True)
class Context:
    """What a plan needs besides its rows: reference tables and the clock."""

    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    as_of: date | None = None

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise LookupError(f"reference table {name} is not there yet")
        return self.tables[name]

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)


def unmarked(df: DataFrame) -> DataFrame:
    """Start of an audit: nothing rejected yet."""
    return df.withColumn(FAILED, F.array().cast("array<string>"))


def alive() -> Column:
    return F.size(FAILED) == 0


def _reject(df: DataFrame, reasons: Column) -> DataFrame:
    return df.withColumn(FAILED, F.when(alive(), reasons).otherwise(F.col(FAILED)))


@dataclass(frozen=True)
class Drop:
    columns: Sequence[str]

    def keep(self, df: DataFrame, context: Context) -> DataFrame:
        return df.drop(*self.columns)

    audit = keep


@dataclass(frozen=True)
class Typed:
    """Lenient casts; ``rest`` keeps the columns not named."""

    schema: Mapping[str, str]
    rest: bool = False

    def keep(self, df: DataFrame, context: Context) -> DataFrame:
        if self.rest:
            return typed_columns(df, self.schema)
        return typed_select(df, self.schema, carry=[FAILED] if FAILED in df.columns else [])

    audit = keep


@dataclass(frozen=True)
class Derive:
    """New or replaced columns, all computed from the columns before the step."""

    columns: Callable[[Context], Mapping[str, Column]]

    def keep(self, df: DataFrame, context: Context) -> DataFrame:
        return df.withColumns(dict(self.columns(context)))

    audit = keep


@dataclass(frozen=True)
class Reshape:
    """Any row-by-row change of the columns that passes ``FAILED`` through."""

    change: Callable[[DataFrame], DataFrame]

    def keep(self, df: DataFrame, context: Context) -> DataFrame:
        return self.change(df)

    audit = keep


@dataclass(frozen=True)
class Latest:
    grain: Sequence[str]
    order: Sequence[str] = ("ingest_time",)
    message: str = "duplicate"
    # no grain is too large for one task
    gathered: bool = False

    def keep(self, df: DataFrame, context: Context) -> DataFrame:
        return latest(df, self.grain, self.order)

    def audit(self, df: DataFrame, context: Context) -> DataFrame:
        marked = mark_latest(df, self.grain, self.order, "__latest", alive(), self.gathered)
        reasons = F.when(~F.col("__latest"), F.array(F.lit(self.message))).otherwise(F.col(FAILED))
        return _reject(marked, reasons).drop("__latest")


@dataclass(frozen=True)
class Check:
    rules: Sequence[Rule]

    def keep(self, df: DataFrame, context: Context) -> DataFrame:
        return valid_rows(df, self.rules)

    def audit(self, df: DataFrame, context: Context) -> DataFrame:
        return _reject(df, broken(self.rules))


@dataclass(frozen=True)
class References:
    """Foreign keys, and rules judged together with them."""

    references: Sequence[Reference]
    rules: Sequence[Rule] = ()

    def keep(self, df: DataFrame, context: Context) -> DataFrame:
        kept = valid_rows(df, self.rules) if self.rules else df
        for reference in self.references:
            kept = referenced(kept, context.table(reference.table), reference)
        return kept

    def audit(self, df: DataFrame, context: Context) -> DataFrame:
        flags = [f"__missing_{n}" for n, _ in enumerate(self.references)]
        marked = df
        for reference, flag in zip(self.references, flags):
            marked = mark_reference(marked, context.table(reference.table), reference, flag)
        missing = [
            F.when(F.col(flag), F.lit(reference.message))
            for reference, flag in zip(self.references, flags)
        ]
        texts = [*missing, *[rule.text_if_broken() for rule in self.rules]]
        return _reject(marked, F.array_compact(F.array(*texts))).drop(*flags)
