"""Registry of queries and access to the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Tables:
    """The given tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a query in which ``{name}`` stands for a given table."""
        used = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(for_spark(text), **{name: getattr(self, name) for name in used})


def for_spark(text: str) -> str:
    """DAYS(n) and SECONDS(n) are intervals, spelt differently by each engine."""
    text = re.sub(r"DAYS\(([^()]*)\)", r"make_dt_interval(cast(\1 as int))", text)
    return re.sub(r"SECONDS\(([^()]*)\)", r"make_dt_interval(0, 0, 0, \1)", text)


def for_duckdb(text: str) -> str:
    text = re.sub(r"DAYS\(([^()]*)\)", r"to_days(cast(\1 as int))", text)
    text = re.sub(r"SECONDS\(([^()]*)\)", r"to_seconds(\1)", text)
    return re.sub(r"\{(\w+)\}", r"\1", text)


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def comparable(df: DataFrame) -> DataFrame:
    """Types that every engine's client shows alike: dates as text, decimals
    as doubles, timestamps without zone."""

    def shown(name: str, dtype: str):
        column = F.col(f"`{name}`")
        if dtype == "date":
            return column.cast("string").alias(name)
        if dtype.startswith("decimal"):
            return column.cast("double").alias(name)
        if dtype == "timestamp":
            return column.cast("timestamp_ntz").alias(name)
        return column

    return df.select(*[shown(name, dtype) for name, dtype in df.dtypes])


def query(name: str, sql: str | None = None):
    """Register a function of the given tables under a name."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Tables(spark, sf_dir)))

        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = Query(name, run, None if sql is None else for_duckdb(sql).strip())
        return build

    return register
