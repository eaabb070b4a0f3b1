"""File sources: seeds, loose sets of CSV files, files changed since a moment."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators.quality import union_all
from tidewell.sources.lineage import stamp_landing


log = logging.getLogger(__name__)


def changed_files(
    spark: SparkSession, path: str, schema: StructType | str, after: datetime | None = None
) -> DataFrame:
    """Rows of the CSV files written or overwritten after a moment, each with
    the time its file was changed (the next watermark)."""
    reader = spark.read.schema(schema).option("header", True)
    if after is not None:
        # Keeps whole files out of the scan; the time has no fractions here.
        reader = reader.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S"))
    rows = reader.csv(path).select("*", F.col("_metadata.file_modification_time").alias("changed_at"))
    return rows if after is None else rows.filter(F.col("changed_at") > F.lit(after))


def load_seed(
    seed: DataFrame,
    table: DataFrame | None,
    batch_id: str,
    source: str,
    at: datetime | None = None,
    restamp: str = "new",
) -> DataFrame:
    """The table after loading a seed.

    ``restamp="new"`` stamps the added rows only; ``"all"`` gives the rows that
    were there the stamps of this load as well.
    """
    if restamp not in ("new", "all"):
        raise ValueError("restamp must be 'new' or 'all'")
    lineage = ["dw_ingested_at", "dw_source_file", "dw_batch_id"]
    fresh = stamp_landing(seed.drop(*lineage), batch_id, at, source)
    if table is None:
        return fresh
    kept = table
    if restamp == "all":
        kept = stamp_landing(table.drop(*lineage), batch_id, at, source)
    return union_all([kept, fresh])


def _first_like(columns: Sequence[str], word: str) -> str | None:
    return next((c for c in columns if word in c.lower()), None)


def ticket_texts(frames: Sequence[DataFrame], skipped: list[tuple[int, str]] | None = None) -> DataFrame:
    """Description and kind of tickets from files with unlike headers.

    The description is the first column whose name contains that word, the kind
    the first whose name contains category or type.  Frames without a
    description are added to ``skipped``, by number and reason.
    """
    found = []
    for number, frame in enumerate(frames):
        description = _first_like(frame.columns, "description")
        if description is None:
            log.warning("frame %s has no description column among %s", number, frame.columns)
            if skipped is not None:
                skipped.append((number, "no description column"))
            continue
        kind = next((c for c in frame.columns if "category" in c.lower() or "type" in c.lower()), None)
        kind_value: Column = F.col(f"`{kind}`") if kind else F.lit(None)
        found.append(
            frame.select(
                F.col(f"`{description}`").cast("string").alias("description"),
                kind_value.cast("string").alias("kind"),
            )
        )
    if not found:
        raise ValueError("no file has a description column")
    return union_all(found)


def read_csv_set(
    spark: SparkSession, paths: Sequence[str], multi_line: bool = False
) -> list[DataFrame]:
    """One frame per path, all text; a file that cannot be read fails the read.

    ``multi_line`` allows line breaks inside values, at the price that a file
    is read by one task.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    return [reader.csv(p) for p in paths]
