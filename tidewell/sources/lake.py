"""Lake tables: parquet directories addressed by path."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewell.functions.lattice import as_type, wider
from tidewell.session import remove_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at this path, on any Hadoop file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


_STORED = "version int, body string"


def _newest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    if not path_exists(spark, path):
        return 0, None
    found = spark.read.schema(_STORED).json(path).agg(F.max("version"), F.max_by("body", "version")).first()
    return found[0] or 0, found[1]


def load_schema(spark: SparkSession, path: str) -> StructType | None:
    """The newest schema stored at a path."""
    newest = _newest(spark, path)[1]
    return None if newest is None else StructType.fromJson(json.loads(newest))


def store_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Store a schema as the newest version."""
    row = [(max(len(schema.fields), _newest(spark, path)[0] + 1), schema.json())]
    spark.createDataFrame(row, _STORED).write.mode("append").json(path)


# Beside the data of a table that may hold no rows yet; Spark skips the name.
SCHEMA_FOLDER = "_schema"


# Where a column's type was widened, later files go to a folder of their own, and the
# schema of the files before is kept: no file is written again and each is read by its types.
EARLIER_TYPES = "_types"
TYPES = "dw_types"


# Beside the data of a table that is upserted: which load each bucket is read from.
LOADS_FOLDER = "_loads"
LOAD, BUCKET = "load", "merge_bucket"


@dataclass(frozen=True)
class Loaded:
    """State of an upserted table; ``loads`` names the load of each bucket that has rows."""

    version: int
    buckets: int
    keys: list[str]
    loads: Mapping[int, str]

    def after(self, changed: Mapping[int, str]) -> Loaded:
        return Loaded(self.version + 1, self.buckets, self.keys, {**self.loads, **changed})


_STATE = "state="


def _states(spark: SparkSession, path: str) -> list[str]:
    """Folders of an upserted table's states, newest first, found by listing."""
    store = f"{path}/{LOADS_FOLDER}"
    return sorted(list_folders(spark, store, _STATE), reverse=True) if path_exists(spark, store) else []


def current_load(spark: SparkSession, path: str) -> Loaded | None:
    """The newest state of an upserted table, None for other tables; one small file is read."""
    for folder in _states(spark, path):
        # a folder without its file belongs to a load that was interrupted
        if list_folders(spark, folder, "part-"):
            return _loaded(spark.read.schema(_STORED).json(folder).first()["body"])
    store = f"{path}/{LOADS_FOLDER}"
    if not path_exists(spark, store):
        return None
    # tables of before states had folders
    newest = _newest(spark, store)[1]
    return None if newest is None else _loaded(newest)


def state_at(spark: SparkSession, path: str, version: int) -> Loaded | None:
    """An earlier state of an upserted table, None once it was vacuumed."""
    folder = f"{path}/{LOADS_FOLDER}/{_STATE}{version:012d}"
    if not path_exists(spark, folder) or not list_folders(spark, folder, "part-"):
        return None
    return _loaded(spark.read.schema(_STORED).json(folder).first()["body"])


def _loaded(body: str) -> Loaded:
    state = json.loads(body)
    return Loaded(state["version"], state["buckets"], state["keys"], {int(b): name for b, name in state["loads"].items()})


def commit_load(spark: SparkSession, path: str, state: Loaded) -> None:
    """Make a state the newest one: one small file, which appears whole or not at all."""
    row = spark.createDataFrame([(state.version, json.dumps(asdict(state)))], _STORED)
    row.coalesce(1).write.mode("overwrite").json(f"{path}/{LOADS_FOLDER}/{_STATE}{state.version:012d}")


def drop_old_states(spark: SparkSession, path: str) -> None:
    """Delete all states of an upserted table but the newest."""
    whole = [f for f in _states(spark, path) if list_folders(spark, f, "part-")]
    for folder in whole[1:]:
        remove_path(spark, folder)


def list_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Folders and files right below a path whose name has a prefix."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [f"{path}/{s.getPath().getName()}" for s in found if s.getPath().getName().startswith(prefix)]


def read_lake(spark: SparkSession, path: str, evolving: bool = False) -> DataFrame:
    """Read a table; ``evolving`` unites the schemas of all its files.

    A schema kept with the table is used as it is, without opening files.
    """
    stored = load_schema(spark, f"{path}/{SCHEMA_FOLDER}")
    state = current_load(spark, path)
    if state is not None:
        if not state.loads:
            return spark.createDataFrame([], stored)
        folders = [f"{path}/{LOAD}={load}" for load in sorted(set(state.loads.values()))]
        named = F.create_map(*[F.lit(x) for pair in state.loads.items() for x in pair])
        rows = spark.read.schema(stored.add(LOAD, "string")).option("basePath", path).parquet(*folders)
        return rows.filter(F.col(LOAD) == named[F.col(BUCKET)]).drop(LOAD)
    if stored is not None:
        earlier = earlier_types(spark, path)
        return _of_all_types(spark, path, stored, earlier) if earlier else spark.read.schema(stored).parquet(path)
    return spark.read.option("mergeSchema", evolving).parquet(path)


def earlier_types(spark: SparkSession, path: str) -> list[StructType]:
    """The schemas a table had before each widening of a type, oldest first."""
    store = f"{path}/{EARLIER_TYPES}"
    if not path_exists(spark, store):
        return []
    found = spark.read.schema(_STORED).json(store).groupBy("version").agg(F.max("body").alias("body"))
    return [StructType.fromJson(json.loads(r["body"])) for r in found.orderBy("version").collect()]


def data_folder(spark: SparkSession, path: str) -> str:
    """Where a table's next files go."""
    widenings = len(earlier_types(spark, path))
    return f"{path}/{TYPES}={widenings}" if widenings else path


def data_folders(spark: SparkSession, path: str) -> list[str]:
    """Every folder that holds files of one set of types."""
    roots = [path, *[f"{path}/{TYPES}={n + 1}" for n in range(len(earlier_types(spark, path)))]]
    return [r for r in roots if path_exists(spark, r)]


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a schema with its types; other columns as they are."""
    kinds = {f.name: f.dataType for f in schema.fields}
    same = all(kinds.get(f.name, f.dataType) == f.dataType for f in df.schema.fields)
    return df if same else df.select(*[as_type(F.col(f"`{f.name}`"), f.dataType, kinds.get(f.name, f.dataType)).alias(f.name) for f in df.schema.fields])


def _of_all_types(spark: SparkSession, path: str, stored: StructType, earlier: Sequence[StructType]) -> DataFrame:
    parts = []
    for number, types in enumerate([*earlier, stored]):
        root = f"{path}/{TYPES}={number}" if number else path
        if not path_exists(spark, root):
            continue
        folders = [f for f in list_folders(spark, root, "") if f.rpartition("/")[2][:1] not in "_."]
        folders = [f for f in folders if not f.rpartition("/")[2].startswith(f"{TYPES}=")]
        if not folders:
            continue
        kinds = {f.name: f.dataType for f in types.fields}
        schema = StructType([StructField(f.name, kinds.get(f.name, f.dataType), True) for f in stored.fields])
        rows = spark.read.schema(schema).option("basePath", root).parquet(*folders)
        parts.append(cast_to(rows, stored))
    if not parts:
        return spark.createDataFrame([], stored)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_or_none(spark: SparkSession, path: str, evolving: bool = False) -> DataFrame | None:
    return read_lake(spark, path, evolving) if path_exists(spark, path) else None


def remember_schema(spark: SparkSession, path: str, schema: StructType, new: bool = False, widen: bool = False) -> StructType | None:
    """Keep the columns of a table beside it and add those that are new; returns them all.

    Later reads need not open every file to unite their schemas.  A table that
    was written without its schema stays so, unless it is said to be ``new``.
    With ``widen`` a column of another type takes the least type that holds both; files
    written before keep theirs.
    """
    store = f"{path}/{SCHEMA_FOLDER}"
    known = load_schema(spark, store)
    if known is None and not new and path_exists(spark, path):
        return None
    fields = {f.name: f for f in known.fields} if known else {}
    widened = False
    for field in schema.fields:
        held = fields.setdefault(field.name, field)
        if held.dataType == field.dataType:
            continue
        if not widen:
            raise ValueError(
                f"column {field.name} of {path} is {held.dataType.simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
        kind = wider(held.dataType, field.dataType)
        widened = widened or kind != held.dataType
        fields[field.name] = StructField(field.name, kind, True)
    whole = StructType(list(fields.values()))
    if widened:
        # the schema comes last: a job that ends between the two may be repeated
        row = [(len(earlier_types(spark, path)), known.json())]
        spark.createDataFrame(row, _STORED).write.mode("append").json(f"{path}/{EARLIER_TYPES}")
    if known is None or widened or len(fields) > len(known.fields):
        store_schema(spark, store, whole)
    return whole


def load_mark(spark: SparkSession, path: str) -> str | None:
    """The last mark stored at a path."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(_STORED).json(path).agg(F.max_by("body", "version")).first()[0]


def store_mark(spark: SparkSession, path: str, mark: str) -> None:
    """Store how far a job came; call it when the job has succeeded."""
    last = 0
    if path_exists(spark, path):
        last = spark.read.schema(_STORED).json(path).agg(F.max("version")).first()[0] or 0
    spark.createDataFrame([(last + 1, mark)], _STORED).coalesce(1).write.mode("append").json(path)


def append(df: DataFrame, path: str, by: Sequence[str] = (), widen: bool = False) -> None:
    """Append, in folders per value of ``by``; new columns are allowed, and with
    ``widen`` other types are too."""
    schema = remember_schema(df.sparkSession, path, df.schema, widen=widen)
    if schema is not None:
        df = cast_to(df, schema)
    if by:
        df = df.hint("rebalance", *by)
    df.write.mode("append").partitionBy(*by).parquet(data_folder(df.sparkSession, path))


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_unless_empty(df: DataFrame, path: str, by: Sequence[str] = (), widen: bool = False) -> int:
    """Append where there is anything to write.  Returns the number of rows, which
    are counted first, by the columns the filters need."""
    found = df.count()
    if found:
        append(df, path, by, widen)
    return found


def write_monthly_csv(df: DataFrame, path: str, stamp: str = "created_at") -> None:
    """CSV files in year / month folders of a stamp; only the months present in
    the frame are replaced.

    The rebalance hint gives a small month one file and splits a large one.
    """
    if stamp not in df.columns:
        raise ValueError(f"cannot partition by month: no column {stamp}")
    when = F.col(stamp).try_cast("timestamp")
    (
        df.withColumns({"year": F.year(when), "month": F.month(when)})
        .hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("year", "month")
        .csv(path)
    )
