"""Stored, growing schemas for CSV drops.

Spark maps CSV columns by position.  A schema may therefore grow at its end
only; a header that does not continue the stored one is refused instead of
being read into the wrong columns.  The type of a column grows with the values
of later files (see ``functions.lattice``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.functions.lattice import fits_all, least_type, settled, wider
from tidewell.sources.lake import load_schema, path_exists, store_schema


def widened(known: StructType | None, found: StructType) -> StructType:
    """Known fields with their types, then the new ones."""
    if known is None:
        return found
    shared = min(len(known.fields), len(found.fields))
    if known.names[:shared] != found.names[:shared]:
        raise ValueError(f"columns {found.names} do not continue the known {known.names}")
    return StructType([*known.fields, *found.fields[len(known.fields):]])


def grown(known: StructType | None, found: StructType) -> StructType:
    """Known fields in types that hold the found values too, then the new ones."""
    kept = widened(known, found)
    kinds = {f.name: f.dataType for f in found.fields}
    return StructType([StructField(f.name, wider(f.dataType, kinds.get(f.name, f.dataType)), True) for f in kept.fields])


def files_by_header(
    spark: SparkSession, source: str, after: datetime | None = None
) -> tuple[dict[str, str], datetime | None]:
    """Header line -> one of the files that have it, and when the last file was changed.

    The first line of a file is read by the task that reads its first block, in
    order, so the partial aggregate keeps one short row per file.  One row per header
    reaches the driver.
    """
    about = ["_metadata.file_path", "_metadata.file_block_start", "_metadata.file_modification_time"]
    lines = _changed_after(spark, after).text(source).select("value", *about).filter("file_block_start = 0")
    files = lines.groupBy("file_path").agg(F.first("value").alias("header"), F.max("file_modification_time").alias("changed_at"))
    headers = files.groupBy("header").agg(F.min("file_path").alias("file"), F.max("changed_at").alias("changed_at"))
    found, newest = {}, after
    for row in headers.collect():
        found[row.header] = row.file
        newest = max(newest or row.changed_at, row.changed_at)
    return found, newest


def _changed_after(spark: SparkSession, after: datetime | None) -> DataFrameReader:
    reader = spark.read.option("recursiveFileLookup", True)
    if after is None:
        return reader
    # The option has no fractions of a second: the last files come again.
    return reader.option("modifiedAfter", (after - timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S"))


def as_text(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def infer_schema(
    spark: SparkSession,
    source: str,
    layouts: dict[str, str],
    known: StructType | None = None,
    after: datetime | None = None,
    widen: bool = True,
) -> StructType:
    """The schema of the CSV files changed after a moment, continuing the known one.

    All rows of all these files take part in one aggregate, which finds the least type
    of each column; a type only grows.  Without ``widen`` known columns keep theirs.
    """
    names = None if known is None else as_text(known.names)
    for _, file in sorted(layouts.items(), key=lambda item: item[0].count(",")):
        names = widened(names, as_text(_names(spark, file)))
    if names is None:
        raise ValueError("no CSV files to take a schema from")
    rows = _changed_after(spark, after).schema(names).option("header", True).csv(source)
    # one after another, as a name may hold any character
    shapes = rows.toDF(*[f"c{n}" for n in range(len(names.fields))])
    fits = shapes.agg(*[fits_all(F.col(c)).alias(c) for c in shapes.columns]).first()
    found = StructType([StructField(n, least_type(f), True) for n, f in zip(names.names, fits)])
    schema = grown(known, found) if widen else widened(known, found)
    # columns without a value so far take the type of their first one
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def _names(spark: SparkSession, file: str) -> Sequence[str]:
    return spark.read.option("header", True).csv(file).schema.names


def current_schema(spark: SparkSession, source: str, store: str, widen: bool = True) -> StructType:
    """The stored schema widened by the files that came or changed since it was stored."""
    seen = f"{store}/_seen"
    marks = "seen_until timestamp"
    until = None
    if path_exists(spark, seen):
        until = spark.read.schema(marks).json(seen).agg(F.max("seen_until")).first()[0]
    known = load_schema(spark, store)
    layouts, newest = files_by_header(spark, source, until)
    if not layouts and known is not None:
        return settled(known)
    schema = infer_schema(spark, source, layouts, known, until, widen)
    if schema != known:
        store_schema(spark, store, schema)
    if newest != until:
        spark.createDataFrame([(newest,)], marks).write.mode("append").json(seen)
    return settled(schema)
