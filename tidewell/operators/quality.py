"""Validation rules, valid / quarantine splits and quality reports.

A rule is a SQL condition that must be *true*; null counts as broken, so each
row ends in exactly one side of a split.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    holds: str
    message: str

    def ok(self) -> Column:
        return F.coalesce(F.expr(self.holds), F.lit(False))

    def text_if_broken(self) -> Column:
        return F.when(~self.ok(), F.lit(self.message))


def _quoted(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def required(column: str, message: str | None = None) -> Rule:
    return Rule(f"{column}_required", f"{column} is not null", message or f"{column} is null")


def all_required(columns: Sequence[str]) -> list[Rule]:
    return [required(c) for c in columns]


def one_of(column: str, values: Iterable[str], message: str | None = None) -> Rule:
    return Rule(f"{column}_domain", f"{column} in ({_quoted(values)})", message or f"invalid {column}")


def within(column: str, low: int, high: int) -> Rule:
    return Rule(
        f"{column}_range",
        f"{column} between {low} and {high}",
        f"{column} outside {low}-{high}",
    )


def not_negative(column: str) -> Rule:
    return Rule(f"{column}_sign", f"{column} >= 0", f"invalid {column}")


def ordered(first: str, second: str, strict: bool = False, open_end: bool = False) -> Rule:
    """``first`` before ``second`` (or the same day unless ``strict``)."""
    test = f"{first} {'<' if strict else '<='} {second}"
    if open_end:
        test = f"{second} is null or {test}"
    return Rule(f"{second}_order", test, f"{second} before {first}")


def error_text(rules: Sequence[Rule]) -> Column:
    """Messages of all broken rules joined by ``; `` -- empty for a valid row."""
    return F.concat_ws("; ", *[r.text_if_broken() for r in rules])


def broken(rules: Sequence[Rule]) -> Column:
    """Messages of all broken rules as an array."""
    return F.array_compact(F.array(*[r.text_if_broken() for r in rules]))


def with_flags(df: DataFrame, rules: Sequence[Rule], record_flag: str = "is_valid_record") -> DataFrame:
    """One boolean per rule and one for the record."""
    flags = {f"is_valid_{r.name}": r.ok() for r in rules}
    return df.withColumns({**flags, record_flag: all_hold(rules)})


def all_hold(rules: Sequence[Rule]) -> Column:
    return reduce(Column.__and__, [r.ok() for r in rules])


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows for which every rule holds.

    A filter drops null conditions by itself, so the bare conditions are used:
    those the source understands are pushed down to it.
    """
    for rule in rules:
        df = df.filter(F.expr(rule.holds))
    return df


def split(
    df: DataFrame, rules: Sequence[Rule], reason: str = "validation_error"
) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with their reasons."""
    return valid_rows(df, rules), df.filter(~all_hold(rules)).withColumn(reason, error_text(rules))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Stamps keep their microseconds in a payload.
_PAYLOAD = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def envelope(df: DataFrame, entity: str, failures: str, batch_id: str | Column, besides: Sequence[str] = ()) -> DataFrame:
    """Rejected rows of any entity in one shape.

    ``failures`` is the array of messages; the first is the rule the row is
    counted under.  The row itself, without the columns ``besides``, is kept as JSON.
    """
    payload = [c for c in df.columns if c not in (failures, *besides)]
    return df.select(
        F.lit(entity).alias("entity"),
        F.col(failures)[0].alias("rule"),
        F.array_join(failures, "; ").alias("reason"),
        F.to_json(F.struct(*payload), _PAYLOAD).alias("payload"),
        (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).alias("batch_id"),
    )


def quality_report(audited: DataFrame, failures: str, entity: str) -> DataFrame:
    """Rows per broken rule (a row counts for each rule it breaks), plus the
    accepted and rejected totals -- one pass over the audited rows."""
    outcome = F.when(F.size(failures) == 0, F.array(F.lit("accepted rows"))).otherwise(
        F.concat(F.array(F.lit("rejected rows")), F.col(failures))
    )
    return (
        audited.select(F.explode(outcome).alias("measure"))
        .groupBy("measure")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(entity).alias("entity"), "measure", "row_count")
    )


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column and how often each occurs."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
