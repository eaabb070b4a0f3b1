"""An entity plan: from raw rows to one curated table and its quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.casting import lenient
from tidewell.operators.dedup import latest, split_hot
from tidewell.operators.quality import envelope, quality_report
from tidewell.operators.upsert import merge_frames
from tidewell.plans.steps import FAILED, Check, Context, Derive, Latest, References, Reshape, Typed, alive, unmarked

SUPERSEDED = "superseded by a newer row of the key"
REFUSED = "not newer than the stored row of the key"


def _narrow_first(steps: Sequence[Any], held: set[str], context: Context) -> list[Any]:
    """The last choice of a row before the derivations at the end, if these only add columns:
    such columns follow from others and decide no tie."""
    *before, last = steps
    tail = len(before)
    while tail and isinstance(before[tail - 1], Derive) and not held & set(before[tail - 1].columns(context)):
        tail -= 1
    return [*before[:tail], last, *before[tail:]]


def _audited(steps: Sequence[Any], rows: DataFrame, context: Context) -> DataFrame:
    """Rows after the audit of every step.  From the first reference on, rows that are
    rejected already are judged no more and keep out of its joins and contests."""
    first = next((n for n, step in enumerate(steps) if isinstance(step, References)), len(steps))
    for step in steps[:first]:
        rows = step.audit(rows, context)
    if first == len(steps):
        return rows
    rejected, rows = rows.filter(~alive()), rows.filter(alive())
    for step in _narrow_first(steps[first:], set(rows.columns), context):
        rows = step.audit(rows, context)
        if not isinstance(step, (Check, Latest, References)):
            rejected = step.audit(rejected, context)
    return rows.unionByName(rejected)


@dataclass(frozen=True)
class EntityPlan:
    """Steps in order, then one row per key for the upsert.

    ``newest`` orders the rows of one ``batch_key`` (the merge key unless
    given; it must be part of that key).  ``newer_than`` is the stamp that must
    grow for an update, None for unconditional updates.
    """

    name: str
    columns: Sequence[str]
    steps: Sequence[Any]
    merge_keys: Sequence[str]
    newest: Sequence[str]
    newer_than: str | None = "ingest_time"
    extra_columns: bool = False
    batch_key: Sequence[str] = ()

    def _shaped(self, df: DataFrame) -> DataFrame:
        if not self.extra_columns:
            return df.select(*self.columns)
        known = set(self.columns)
        others = [c for c in df.columns if c not in known and c != FAILED]
        return df.select(*self.columns, *others)

    def also(self, *steps: Any) -> EntityPlan:
        """The plan with further steps at its end."""
        return replace(self, steps=[*self.steps, *steps])

    def curated(self, raw: DataFrame, context: Context) -> DataFrame:
        """Rows that pass every step."""
        rows = raw
        for step in self.steps:
            rows = step.keep(rows, context)
        return self._shaped(rows)

    def batch(self, raw: DataFrame, context: Context) -> DataFrame:
        """Curated rows reduced to one per key."""
        return self.reduced(self.curated(raw, context))

    def reduced(self, curated: DataFrame) -> DataFrame:
        return latest(curated, self.batch_key or self.merge_keys, self.newest)

    def audited(self, raw: DataFrame, context: Context) -> DataFrame:
        """Every row, with the reasons for which it was rejected.

        Where one raw column is part of every grain, rows are dealt by it once and lie
        right for every choice of a latest row; those of hot keys are ranked in lanes.
        """
        rows = unmarked(raw)
        steps = [*self.steps, Latest(self.batch_key or self.merge_keys, self.newest, SUPERSEDED)]
        key = self._common_key(steps, context)
        if key is None:
            return _audited(steps, rows, context)
        name, typed = key
        cold, hot = split_hot(rows, typed)
        gathered = [replace(s, gathered=True) if isinstance(s, Latest) else s for s in steps]
        parts = [_audited(gathered, cold.repartition(name), context), _audited(steps, hot, context)]
        return parts[0].unionByName(parts[1])

    def _common_key(self, steps: Sequence[Any], context: Context) -> tuple[str, Column] | None:
        """A raw column in every grain, and its value at the end of the plan by which rows
        of one key are known; None where a step makes the column anew."""
        grains = [s.grain for s in steps if isinstance(s, Latest)]
        for name in grains[-1]:
            if not all(name in g for g in grains):
                continue
            typed = F.col(name)
            for step in steps:
                if isinstance(step, Typed) and name in step.schema:
                    typed = lenient(typed, step.schema[name])
                elif isinstance(step, Reshape) or (isinstance(step, Derive) and name in step.columns(context)):
                    break
                elif isinstance(step, Typed) and any("<-" in k for k in step.schema):
                    break
            else:
                return name, typed
        return None

    def accepted(self, audited: DataFrame) -> DataFrame:
        """The rows that ``batch`` gives, one per key."""
        return self._shaped(audited.filter(alive()))

    def quarantine(self, audited: DataFrame, batch_id: str = "") -> DataFrame:
        return envelope(audited.filter(~alive()), self.name, FAILED, batch_id)

    def refused(self, rows: DataFrame, batch_id: str = "") -> DataFrame:
        """Accepted rows that the stored table refused, as the quarantine keeps them."""
        return envelope(rows.withColumn(FAILED, F.array(F.lit(REFUSED))), self.name, FAILED, batch_id)

    def report(self, audited: DataFrame) -> DataFrame:
        return quality_report(audited, FAILED, self.name)

    def merged(self, target: DataFrame | None, batch: DataFrame) -> DataFrame:
        """The curated table after the batch."""
        if target is None:
            return batch
        return merge_frames(target, batch, self.merge_keys, self.newer_than)

    def rejected_rows(self, audited: DataFrame) -> DataFrame:
        """Rejected rows in their own columns, with the reasons as text."""
        rejected = audited.filter(~alive())
        return rejected.withColumn("reason", F.array_join(FAILED, "; ")).drop(FAILED)
