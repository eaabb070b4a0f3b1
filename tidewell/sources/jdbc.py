"""Relational sources and sinks over JDBC.

A plain JDBC read is one task.  Give ``Slices`` to read a large table in
parallel over ranges of a numeric, date or timestamp column.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

POSTGRES_DRIVER = "org.postgresql.Driver"

@dataclass(frozen=True)
class Connection:
    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = POSTGRES_DRIVER
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        named = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {**{k: v for k, v in named.items() if v}, **self.extra}


@dataclass(frozen=True)
class Slices:
    column: str
    lower: Any
    upper: Any
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def timestamp_literal(watermark: datetime, url: str = "") -> str:
    """A timestamp as the database of a JDBC address writes it."""
    stamp = watermark.isoformat(sep=" ")
    if url.startswith("jdbc:sqlserver:"):
        return f"CAST('{watermark.isoformat()}' AS datetime2)"
    return f"TIMESTAMP '{stamp}'"


def incremental_query(
    table: str, column: str, watermark: datetime | None, inclusive: bool = False, url: str = ""
) -> str:
    """A subquery the database filters itself.

    Rows without a stamp come with every inclusive read, as no watermark can
    tell whether they were read before.
    """
    if watermark is None:
        return f"(SELECT * FROM {table}) t"
    literal = timestamp_literal(watermark, url)
    if inclusive:
        return f"(SELECT * FROM {table} WHERE {column} >= {literal} OR {column} IS NULL) t"
    return f"(SELECT * FROM {table} WHERE {column} > {literal}) t"


def watermark_query(table: str, column: str) -> str:
    """A subquery with which the database finds the highest value itself."""
    return f"(SELECT MAX({column}) AS watermark FROM {table}) t"


def read_options(
    connection: Connection, dbtable: str, slices: Slices | None = None, fetch: int = 10_000
) -> dict[str, str]:
    base = {**connection.options(), "dbtable": dbtable, "fetchsize": str(fetch)}
    return {**base, **(slices.options() if slices else {})}


def read_table(
    spark: SparkSession, connection: Connection, table: str, slices: Slices | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(connection, table, slices)).load()


def read_after(
    spark: SparkSession,
    connection: Connection,
    table: str,
    column: str,
    watermark: datetime | None,
    slices: Slices | None = None,
    inclusive: bool = False,
) -> DataFrame:
    query = incremental_query(table, column, watermark, inclusive, connection.url)
    return read_table(spark, connection, query, slices)


def read_watermark(
    spark: SparkSession, connection: Connection, table: str, column: str
) -> datetime | None:
    return read_table(spark, connection, watermark_query(table, column)).first()[0]


def column_types(overrides: Mapping[str, str]) -> dict[str, str]:
    """Column types for a table created on first write, as Spark SQL types.

    Columns not named get the type the database's dialect maps them to.
    """
    listed = ", ".join(f"{name} {dtype}" for name, dtype in overrides.items())
    return {"createTableColumnTypes": listed} if listed else {}


def write_options(
    connection: Connection,
    table: str,
    batch: int = 1000,
    writers: int = 16,
    types: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """``writers`` bounds the connections that are open at once."""
    return {
        **connection.options(),
        "dbtable": table,
        "batchsize": str(batch),
        "numPartitions": str(writers),
        **column_types(types or {}),
    }


def append_table(df: DataFrame, connection: Connection, table: str, **options: Any) -> None:
    """Append in batches; the table is created where it is missing."""
    chosen = write_options(connection, table, **options)
    df.write.format("jdbc").options(**chosen).mode("append").save()
