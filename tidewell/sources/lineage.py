"""Lineage columns.

Clock and batch id are arguments: the same batch can be repeated, and a lost
task stamps its rows as before.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.casting import lenient

# Partition column of bronze tables.
INGEST_DAY = "dw_ingest_day"
# Partition column of landing tables that streams write; it goes no further.
LANDING_LOAD = "dw_load"
# Values of a landing row that its column's type does not hold, as JSON text by column.
RESCUED = "dw_rescued"
# When the file of a landing row was last changed; it goes no further either.
FILE_CHANGED = "dw_file_changed_at"

TECHNICAL = ["id", "source_identifier", "batch_id"]


def _clock(at: datetime | None) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def stamp_landing(
    df: DataFrame, batch_id: str, at: datetime | None = None, source: str | Column | None = None
) -> DataFrame:
    """Landing form; the source defaults to the file each row was read from."""
    origin = F.col("_metadata.file_path") if source is None else source if isinstance(source, Column) else F.lit(source)
    return df.select(
        "*",
        _clock(at).alias("dw_ingested_at"),
        origin.alias("dw_source_file"),
        F.lit(batch_id).alias("dw_batch_id"),
    )


def stamp_bronze(
    df: DataFrame, batch_id: str, source_table: str, at: datetime | None = None
) -> DataFrame:
    return df.withColumns(
        {
            "ingest_time": _clock(at),
            "batch_id": F.lit(batch_id),
            "source_table": F.lit(source_table),
        }
    )


# Canonical name -> the names it may come under, in order of preference.
CANONICAL = {
    "ingest_time": ["ingest_time", "dw_ingested_at"],
    "source_identifier": ["source_identifier", "source_table", "dw_source_file"],
    "batch_id": ["batch_id", "dw_batch_id"],
}


def canonical_lineage(df: DataFrame) -> DataFrame:
    """Give both lineage conventions the names the curated layer expects."""
    dtypes = {"ingest_time": "timestamp"}
    found = {}
    for name, sources in CANONICAL.items():
        dtype = dtypes.get(name, "string")
        present = [lenient(s, dtype) for s in sources if s in df.columns]
        found[name] = F.coalesce(*present) if present else F.lit(None).cast(dtype)
    aliases = {s for sources in CANONICAL.values() for s in sources} - set(CANONICAL)
    return df.withColumns(found).drop(*aliases, INGEST_DAY, RESCUED)


def drop_technical(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL)
