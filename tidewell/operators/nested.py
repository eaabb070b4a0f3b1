"""JSON payloads and nested structs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.functions.lattice import joined, known_fields
from tidewell.sources.lake import load_schema, store_schema


# Type words of a variant's schema; quoted names and names before a colon are none.
_TYPE_WORDS = re.compile(r"`(?:[^`]|``)*`|\b(OBJECT|VARIANT|VOID)\b(?!\s*:)")
_SPARK_TYPES = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Replace every struct by its leaves, names joined by ``separator``."""

    def leaves(struct: StructType, path: tuple[str, ...] = ()):
        for field in struct.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                yield F.col(quoted).alias(separator.join(here))

    return df.select(*leaves(df.schema))


def parse_json(df: DataFrame, column: str, schema: str | StructType) -> DataFrame:
    """Replace a JSON text column by the fields of its documents.

    Malformed text gives null fields; fields outside the schema are ignored.
    The fields come out of a generator: later conditions on them are not pushed
    below it, where they would parse every document a second time.
    """
    kept = [F.col(c) for c in df.columns if c != column]
    return df.select(*kept, F.inline_outer(F.array(F.from_json(F.col(column), schema))))


def infer_json_schema(df: DataFrame, column: str) -> str:
    """The schema of all documents in a JSON text column, as DDL.

    Spark folds the documents' types together where they lie; only the
    resulting type reaches the driver.
    """
    found = df.select(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    return _TYPE_WORDS.sub(lambda m: _SPARK_TYPES.get(m[1], m[0]), found)


def grow_json_schema(spark: SparkSession, load: DataFrame, column: str, store: str) -> StructType:
    """The stored schema of a JSON column, widened by the documents of one load, and stored.

    Only the load is read.  Its tree of types is joined with the stored one field by
    field: new fields are added at any depth and types grow along the lattice, whatever
    the order of the loads.  A field that only held nulls so far is left out of the schema
    until a value tells its type.
    """
    ddl = load.select(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    found = _parsed(spark, ddl)
    known = load_schema(spark, store)
    schema = found if known is None else joined(known, found)
    if schema != known:
        store_schema(spark, store, schema)
    return known_fields(schema)


def _parsed(spark: SparkSession, ddl: str) -> StructType:
    """A variant's schema as a type; fields without a value stay without a type."""
    kinds = {**_SPARK_TYPES, "VOID": "VOID"}
    written = _TYPE_WORDS.sub(lambda m: kinds.get(m[1], m[0]), ddl)
    found = spark.createDataFrame([], f"document {written}").schema["document"].dataType
    return found if isinstance(found, StructType) else StructType()
