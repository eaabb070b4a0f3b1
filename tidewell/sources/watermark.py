"""High watermarks and incremental filters."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewell.functions.lattice import wider
from tidewell.operators.references import lacking_reference, unique_keys
from tidewell.sources.lake import cast_to

EPOCH = datetime(1900, 1, 1)


def high_watermark(df: DataFrame | None, column: str, within: str | None = None) -> Any:
    """The highest value of a column, or None for no table or no rows.

    ``within`` names a partition column that grows with the watermark (such as
    the ingest date): only its last partition is then read.
    """
    if df is None:
        return None
    if within is not None:
        last = df.agg(F.max(within)).first()[0]
        if last is None:
            return None
        df = df.filter(F.col(within) == F.lit(last))
    return df.agg(F.max(column)).first()[0]


def watermark_frame(df: DataFrame, column: str, default: Any = None) -> DataFrame:
    """The watermark as a one-row frame, with a default for an empty table."""
    top = F.max(column)
    if default is not None:
        top = F.coalesce(top, F.lit(default))
    return df.agg(top.alias("watermark"))


def rows_after(df: DataFrame, column: str, watermark: Any, inclusive: bool = False) -> DataFrame:
    """Rows past the watermark; all rows on a first run."""
    if watermark is None:
        return df
    bound = F.lit(watermark)
    return df.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def rows_not_held(rows: DataFrame, held: DataFrame | None, column: str, watermark: Any) -> DataFrame:
    """Rows at or past the watermark, or without a stamp, that ``held`` lacks.

    Late rows with the very stamp of the watermark are found.  Rows are compared
    by all columns they have; a column that ``held`` lacks is null there.  Only
    rows of the last stamp, or of none, can have been loaded before.
    """
    if held is None:
        return rows
    doubtful = F.col(column).isNull()
    if watermark is not None:
        doubtful = doubtful | (F.col(column) == F.lit(watermark))
        rows = rows.filter((F.col(column) >= F.lit(watermark)) | F.col(column).isNull())
    names = sorted(rows.columns)
    kinds = {c: wider(rows.schema[c].dataType, held.schema[c].dataType) for c in names if c in held.columns}
    rows, held = (cast_to(df, StructType([StructField(c, k) for c, k in kinds.items()])) for df in (rows, held))
    known = [F.col(c) if c in held.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in names]

    def identity(columns):
        return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))

    before = unique_keys(held.filter(doubtful).select(identity(known).alias("__held")))
    named = rows.withColumn("__identity", identity([F.col(c) for c in names]))
    # digests are far wider than the compressed rows by which Spark judges their size, so
    # they would be broadcast through the driver long past its threshold
    return named.join(before.hint("merge"), F.col("__identity") == F.col("__held"), "left_anti").drop("__identity")


def rows_to_copy(
    source: DataFrame, target: DataFrame | None, column: str, key: Mapping[str, str]
) -> DataFrame:
    """Rows at or past the target's watermark that the target does not hold.

    Late rows with the very stamp of the watermark are found, and repeated runs
    copy nothing twice.
    """
    if target is None:
        return source
    mark = high_watermark(target, column)
    fresh = rows_after(source, column, mark, inclusive=True)
    if mark is None:
        return fresh
    return lacking_reference(fresh, target.filter(F.col(column) >= F.lit(mark)), key)
