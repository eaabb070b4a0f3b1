"""Incremental ingest, file sources and streams.

The stored tables these queries read back are written by Spark from the given
tables into a fresh folder below the shared scratch folder.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewell.catalogue import curated
from tidewell.catalogue.base import Tables, query
from tidewell.operators.nested import flatten_structs, grow_json_schema, parse_json
from tidewell.plans.entities import SUBSCRIPTIONS
from tidewell.operators.upsert import upsert_path
from tidewell.plans.jobs import curate_all, landing_to_bronze, publish, seed_table
from tidewell.session import scratch_path
from tidewell.sources import files, lake, watermark
from tidewell.sources.lake import BUCKET
from tidewell.sources.lineage import stamp_landing
from tidewell.streaming import landing, sessions

AT = datetime(2024, 5, 1, 12)
_HALF = "timestamp '2024-01-16 00:00:00'"


@query("watermark_max", "select max(ts) as watermark from events")
def watermark_max(t: Tables):
    return watermark.watermark_frame(t.events, "ts")


@query(
    "watermark_max_default",
    "select coalesce(max(ts), timestamp '1900-01-01') as watermark from events where event_type = 'refund'",
)
def watermark_max_default(t: Tables):
    refunds = t.events.filter("event_type = 'refund'")
    return watermark.watermark_frame(refunds, "ts", watermark.EPOCH)


@query(
    "incremental_after",
    f"select * from events where ts > (select max(ts) from events where ts < {_HALF})",
)
def incremental_after(t: Tables):
    mark = watermark.high_watermark(t.events.filter(f"ts < {_HALF}"), "ts")
    return watermark.rows_after(t.events, "ts", mark)


_COPIED = "o_orderdate <= timestamp '1998-06-01 00:00:00' and o_orderstatus <> 'P'"


@query(
    "inclusive_copy",
    f"""select * from orders where o_orderdate >= (select max(o_orderdate) from orders where {_COPIED})
        and o_orderkey not in (select o_orderkey from orders where {_COPIED})""",
)
def inclusive_copy(t: Tables):
    """Rows with the stamp of the watermark are found, none is copied twice."""
    held = t.orders.filter(_COPIED)
    return watermark.rows_to_copy(t.orders, held, "o_orderdate", {"o_orderkey": "o_orderkey"})


@query(
    "year_month_partition_counts",
    """select year(o_orderdate)::int as year, month(o_orderdate)::int as month, count(*) as row_count,
       sum(cast(o_totalprice as decimal(18,2)))::double as total from orders group by 1, 2""",
)
def year_month_partition_counts(t: Tables):
    """Written as monthly CSV twice (the second time only the late years) and read back."""
    path = scratch_path(t.spark, "monthly-csv")
    rows = t.orders.withColumnRenamed("o_orderdate", "created_at")
    lake.write_monthly_csv(rows, path)
    lake.write_monthly_csv(rows.filter("created_at >= timestamp '2000-01-01 00:00:00'"), path)
    stored = t.spark.read.option("header", True).csv(path)
    return stored.groupBy(F.col("year").cast("int"), F.col("month").cast("int")).agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
    ).toDF("year", "month", "row_count", "total")


@query(
    "bronze_append_evolve",
    """select c_custkey, c_name, null as c_mktsegment from customer where c_acctbal < 0
       union all select c_custkey, c_name, c_mktsegment from customer where c_acctbal >= 0""",
)
def bronze_append_evolve(t: Tables):
    path = scratch_path(t.spark, "bronze-evolve")
    lake.append(t.customer.filter("c_acctbal < 0").select("c_custkey", "c_name"), path)
    lake.append(t.customer.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_mktsegment"), path)
    return lake.read_lake(t.spark, path, evolving=True)


@query(
    "landing_to_bronze",
    """select event_id, case when ts < timestamp '2024-01-16' then timestamp '2024-01-16'
       else timestamp '2024-02-01' end as dw_ingested_at from events""",
)
def landing_to_bronze_query(t: Tables):
    """Two landings, each followed by two bronze loads; the second finds nothing."""
    land, bronze = scratch_path(t.spark, "landing"), scratch_path(t.spark, "bronze")
    early = t.events.filter(f"ts < {_HALF}")
    late = t.events.filter(f"ts >= {_HALF}")
    for rows, at in ((early, datetime(2024, 1, 16)), (late, datetime(2024, 2, 1))):
        lake.append(stamp_landing(rows.select("event_id"), "b", at, "events"), land)
        for _ in range(2):
            landing_to_bronze(t.spark, land, bronze)
    return lake.read_lake(t.spark, bronze).select("event_id", "dw_ingested_at")


@query(
    "seed_restamp_all",
    """select s_suppkey, timestamp '2024-05-02' as dw_ingested_at, 'b2' as dw_batch_id
       from (select s_suppkey from supplier union all select s_suppkey from supplier where s_acctbal < 0)""",
)
def seed_restamp_all(t: Tables):
    path = scratch_path(t.spark, "seed")
    seed = t.supplier.select("s_suppkey")
    seed_table(t.spark, seed, path, "b1", "supplier", AT)
    again = t.supplier.filter("s_acctbal < 0").select("s_suppkey")
    seed_table(t.spark, again, path, "b2", "supplier", datetime(2024, 5, 2), restamp="all")
    return lake.read_lake(t.spark, path).select("s_suppkey", "dw_ingested_at", "dw_batch_id")


@query(
    "seed_load_repeated",
    """select s_suppkey, s_name, case when s_acctbal < 0 then 'b1' else 'b3' end as dw_batch_id from supplier""",
)
def seed_load_repeated(t: Tables):
    """A seed loaded twice, then one that holds all rows: each row comes once."""
    path, seed = scratch_path(t.spark, "seed"), t.supplier.select("s_suppkey", "s_name")
    first = t.supplier.filter("s_acctbal < 0").select("s_suppkey", "s_name")
    for batch_id, rows in (("b1", first), ("b2", first), ("b3", seed), ("b4", seed)):
        seed_table(t.spark, rows, path, batch_id, "supplier", AT, key=["s_suppkey"])
    return lake.read_lake(t.spark, path).select("s_suppkey", "s_name", "dw_batch_id")


@query(
    "changed_files",
    "select c_custkey, c_name from customer where c_acctbal >= 0",
)
def changed_files(t: Tables):
    """Files written after the watermark of the first read."""
    path, columns = scratch_path(t.spark, "drops"), ["c_custkey", "c_name"]
    schema = "c_custkey bigint, c_name string"

    def drop(rows, folder):
        rows.select(*columns).write.option("header", True).csv(f"{path}/{folder}")

    drop(t.customer.filter("c_acctbal < 0"), "day1")
    mark = files.changed_files(t.spark, f"{path}/*", schema).agg(F.max("changed_at")).first()[0]
    drop(t.customer.filter("c_acctbal >= 0"), "day2")
    return files.changed_files(t.spark, f"{path}/*", schema, mark).select(*columns)


@query(
    "csv_set_discovery",
    """select p_name as description, p_type as kind from part
       union all select c_name, c_mktsegment from customer union all select n_name, null from nation""",
)
def csv_set_discovery(t: Tables):
    """Four CSV sets with unlike headers, one without a description."""
    root = scratch_path(t.spark, "csv-set")
    sets = {
        "parts": t.part.select("p_size", F.col("p_name").alias("Ticket Description"), F.col("p_type").alias("Type")),
        "customers": t.customer.select(F.col("c_mktsegment").alias("category"), F.col("c_name").alias("description")),
        "nations": t.nation.select(F.col("n_name").alias("DESCRIPTION"), "n_regionkey"),
        "regions": t.region,
    }
    for name, rows in sets.items():
        rows.write.option("header", True).csv(f"{root}/{name}")
    return files.ticket_texts(files.read_csv_set(t.spark, [f"{root}/{name}" for name in sets]))


def _drop_csv(rows, folder: str) -> None:
    rows.write.mode("append").option("header", True).csv(folder)


@query(
    "landing_stream",
    """select c_custkey::int as c_custkey, c_name, c_acctbal, c_nationkey, case when c_acctbal < 0 then 'run1' else 'run2' end as dw_batch_id,
       case when c_acctbal >= 0 then c_mktsegment end as c_mktsegment from customer""",
)
def landing_stream(t: Tables):
    """Two CSV drops, the second with one column more and every row twice; a
    third run finds nothing."""
    drop = landing.Drop.below(scratch_path(t.spark, "lake"), "users")
    narrow = ["c_custkey", "c_name", "c_acctbal", "c_nationkey"]
    _drop_csv(t.customer.filter("c_acctbal < 0").select(*narrow), f"{drop.source}/d1")
    landing.land_all(t.spark, [drop], "run1", AT)
    rest = t.customer.filter("c_acctbal >= 0").select(*narrow, "c_mktsegment")
    _drop_csv(rest.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy"), f"{drop.source}/d2")
    landing.land_all(t.spark, [drop], "run2", AT)
    landing.land_all(t.spark, [drop], "run3", AT)
    return landing.read_landing(t.spark, drop).select(*narrow, "c_mktsegment", "dw_batch_id")


@query(
    "landing_stream_with_copies",
    "select s_suppkey::int as s_suppkey, s_name from supplier union all select s_suppkey::int, s_name from supplier",
)
def landing_stream_with_copies(t: Tables):
    drop = landing.Drop.below(scratch_path(t.spark, "lake"), "payments")
    for folder in ("d1", "d2"):
        _drop_csv(t.supplier.select("s_suppkey", "s_name"), f"{drop.source}/{folder}")
    landing.land_all(t.spark, [drop], "run1", AT, copies=True)
    return landing.read_landing(t.spark, drop).select("s_suppkey", "s_name")


# What the amounts of three drops look like: whole numbers, fractions, words.
_AMOUNTS = [
    ("c_acctbal < 0", "cast(cast(floor(c_acctbal) as int) as string)"),
    ("c_acctbal >= 0 and c_acctbal < 5000", "cast(c_acctbal as string)"),
    ("c_acctbal >= 5000", "concat('X', c_custkey)"),
]
_AMOUNT_SQL = "case " + " ".join(f"when {which} then {value.replace('string', 'varchar')}" for which, value in _AMOUNTS) + " end"


def _drop_amounts(t: Tables, drop: landing.Drop, run: int) -> None:
    which, value = _AMOUNTS[run]
    rows = t.customer.filter(which).select(F.col("c_custkey").alias("id"), F.expr(value).alias("amount"), "c_name")
    _drop_csv(rows, f"{drop.source}/d{run}")


@query("landing_stream_widened", f"select c_custkey::int as id, {_AMOUNT_SQL} as amount, c_name from customer")
def landing_stream_widened(t: Tables):
    """A column of whole numbers gets fractions, then words: its type grows and no value is lost."""
    drop = landing.Drop.below(scratch_path(t.spark, "lake"), "payments")
    for run in range(3):
        _drop_amounts(t, drop, run)
        landing.land_all(t.spark, [drop], f"run{run}", AT)
    return landing.read_landing(t.spark, drop).select("id", "amount", "c_name")


@query("bronze_widened", f"select c_custkey::int as id, {_AMOUNT_SQL} as amount, day(dw_day)::int as day from (select *, date '2024-05-01' + case when c_acctbal < 0 then 0 when c_acctbal < 5000 then 1 else 2 end as dw_day from customer)")
def bronze_widened(t: Tables):
    """The same drops, each carried on to bronze twice."""
    root = scratch_path(t.spark, "lake")
    drop = landing.Drop.below(root, "payments")
    for run in range(3):
        _drop_amounts(t, drop, run)
        landing.land_all(t.spark, [drop], f"run{run}", datetime(2024, 5, 1 + run))
        for _ in range(2):
            landing_to_bronze(t.spark, drop.target, f"{root}/bronze")
    return lake.read_lake(t.spark, f"{root}/bronze").select("id", "amount", F.day("dw_ingested_at").alias("day"))


@query(
    "landing_stream_rescued",
    f"""select c_custkey::int as id, case when c_acctbal < 0 then cast(floor(c_acctbal) as int) end as amount,
        case when c_acctbal >= 0 then '{{"amount":"' || {_AMOUNT_SQL} || '"}}' end as dw_rescued from customer""",
)
def landing_stream_rescued(t: Tables):
    """Types that stay as they are: what does not fit is kept beside the row."""
    drop = landing.Drop.below(scratch_path(t.spark, "lake"), "payments")
    for run in range(3):
        _drop_amounts(t, drop, run)
        landing.land_all(t.spark, [drop], f"run{run}", AT, widen=False)
    return landing.read_landing(t.spark, drop).select("id", "amount", "dw_rescued")


def _place_csv(t: Tables, rows, file: str) -> None:
    """One CSV file under a given name, replacing what was there."""
    staged = scratch_path(t.spark, "csv")
    rows.coalesce(1).write.option("header", True).csv(staged)
    part = next(f for f in lake.list_folders(t.spark, staged, "part-"))
    path, conf = t.spark._jvm.org.apache.hadoop.fs.Path, t.spark._jsc.hadoopConfiguration()
    system = path(file).getFileSystem(conf)
    t.spark._jvm.org.apache.hadoop.fs.FileUtil.copy(system, path(part), system, path(file), False, True, conf)


@query(
    "landing_stream_overwritten",
    """select s_suppkey::int as id, s_name as name, 'run1' as dw_batch_id from supplier where s_suppkey % 3 <> 0
       union all select s_suppkey::int, 'new ' || s_name, 'run2' from supplier where s_suppkey % 6 = 0""",
)
def landing_stream_overwritten(t: Tables):
    """One of three files is overwritten by fewer, other rows; a third run finds nothing."""
    drop = landing.Drop.below(scratch_path(t.spark, "lake"), "users")
    rows = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    for n in range(3):
        _place_csv(t, rows.filter(f"id % 3 = {n}"), f"{drop.source}/f{n}.csv")
    landing.land_all(t.spark, [drop], "run1", AT)
    _place_csv(t, rows.filter("id % 6 = 0").withColumn("name", F.concat(F.lit("new "), "name")), f"{drop.source}/f0.csv")
    landing.land_all(t.spark, [drop], "run2", AT)
    landing.land_all(t.spark, [drop], "run3", AT)
    return landing.read_landing(t.spark, drop).select("id", "name", "dw_batch_id")


@query("stream_dedup", "select event_id, ts, user_id, event_type, value from events")
def stream_dedup(t: Tables):
    """Every event arrives twice, the second time in a later run."""
    root, columns = scratch_path(t.spark, "stream"), ["event_id", "ts", "user_id", "event_type", "value"]
    events = t.events.select(*columns).withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        events.write.mode("append").parquet(f"{root}/in")
        stream = t.spark.readStream.schema(events.schema).parquet(f"{root}/in")
        once = landing.first_copies(stream, ["event_id"], "ts", "60 days")
        landing.to_table(once, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return t.spark.read.schema(events.schema).parquet(f"{root}/out")


@query(
    "json_stream",
    "select user_id, event_type, value, cast(json_extract_string(props, '$.k') as bigint) as k from events",
)
def json_stream(t: Tables):
    root = scratch_path(t.spark, "json")
    document = F.struct("user_id", "event_type", "value", F.from_json("props", "k bigint").k.alias("k"))
    t.events.select(F.to_json(document)).write.text(f"{root}/in")
    schema = "user_id bigint, event_type string, value double, k bigint"
    parsed = parse_json(landing.json_stream(t.spark, f"{root}/in"), "data", schema)
    landing.to_table(parsed, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return t.spark.read.schema(schema).parquet(f"{root}/out")


@query(
    "foreach_batch_upsert",
    """select o_custkey, o_orderkey, o_totalprice, o_orderdate from (select *, row_number() over (
       partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""",
)
def foreach_batch_upsert(t: Tables):
    """Newest order per customer, upserted run by run.

    Orders of one customer and day would tie, so the stamp holds the key too.
    """
    root = scratch_path(t.spark, "stream-upsert")
    columns = ["o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"]
    stamp = F.struct(F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"))
    orders = t.orders.select(*columns).withColumn("stamp", stamp)
    for load in ("o_totalprice < 150000", "o_totalprice >= 150000"):
        orders.filter(load).write.mode("append").parquet(f"{root}/in")
        stream = t.spark.readStream.schema(orders.schema).parquet(f"{root}/in")
        landing.upsert_stream(
            stream, f"{root}/out", f"{root}/checkpoint", ["o_custkey"], ["stamp"], "stamp", buckets=4
        ).awaitTermination()
    return lake.read_lake(t.spark, f"{root}/out").select(*columns)


@query("publish_subscriptions", curated._batch_sql("subscriptions"))
def publish_subscriptions(t: Tables):
    """Audit, upsert and quarantine written out, the batch published twice."""
    root = scratch_path(t.spark, "publish")
    for _ in range(2):
        publish(
            t.spark,
            SUBSCRIPTIONS,
            curated.raw_rows(t, "subscriptions"),
            curated.context(t, "subscriptions"),
            f"{root}/silver",
            f"{root}/quarantine",
            "b1",
            buckets=4,
        )
    return lake.read_lake(t.spark, f"{root}/silver").drop(BUCKET)


def _late_users(t: Tables) -> str:
    """Subscriptions curated while half of the users are there, then without new rows when all are."""
    root, name = scratch_path(t.spark, "replay"), "subscriptions"
    users = t.sql(curated.REFERENCES["users"])
    lake.append(curated.raw_rows(t, name), f"{root}/bronze/{name}")
    for run, which in enumerate(("user_id % 2 = 0", "user_id % 2 = 1", "user_id is null")):
        upsert_path(t.spark, f"{root}/silver/users", users.filter(which), ["user_id"], buckets=8)
        outcomes = curate_all(t.spark, root, f"b{run}", curated.AS_OF, [name], buckets=4)
        if outcomes[0].status == "failed":
            raise RuntimeError(outcomes[0].detail)
        if run == 0:
            # nothing new comes in later runs but the keys
            lake.overwrite(curated.raw_rows(t, name).limit(0), f"{root}/bronze/{name}")
    return root


@query("quarantine_replay", curated._batch_sql("subscriptions"))
def quarantine_replay(t: Tables):
    """Subscriptions whose users came later are stored, none of them twice."""
    return lake.read_lake(t.spark, f"{_late_users(t)}/silver/subscriptions").drop(BUCKET)


@query(
    "quarantine_replay_left",
    f"""select count(*) filter (reason = 'user_id not found in silver users') as without_user,
        count(*) filter (reason <> '') as quarantined from ({curated._quarantine_sql("subscriptions")})""",
)
def quarantine_replay_left(t: Tables):
    """What is left in the quarantine is what would be there, had all users come first."""
    kept = t.spark.read.parquet(f"{_late_users(t)}/quarantine/subscriptions")
    missing = F.count_if(F.col("reason") == "user_id not found in silver users")
    return kept.agg(missing.alias("without_user"), F.count("*").alias("quarantined"))


# Events come in three deliveries, a third of them one delivery late.
_DELIVERY = "least(2, floor(day(ts) / 11) + case when event_id % 3 = 0 then 1 else 0 end)"
_GAP, _DELAY = timedelta(hours=12), timedelta(days=3)
_DEALT_SQL = f"""with d as (select event_id, ts, user_id, event_type, {_DELIVERY} as k from events),
  m as (select k, max(ts) as top from d group by k),
  b as (select d.*, (select max(top) from m where m.k < d.k) - interval '3 days' as passed from d),
  l as (select *, passed is not null and ts < passed as late from b)"""


def _land_events(t: Tables) -> str:
    root = scratch_path(t.spark, "sessions")
    events = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    for k in range(3):
        events.filter(F.expr(_DELIVERY) == k).orderBy(F.xxhash64("event_id")).write.mode("append").parquet(f"{root}/in/k{k}")
        stream = t.spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        sessions.land_sessions(stream, f"{root}/out", ["user_id"], "ts", _GAP, _DELAY, [F.count_if(F.col("event_type") == "click").alias("clicks")])
    return f"{root}/out"


@query(
    "session_stream",
    f"""{_DEALT_SQL},
  g as (select *, case when ts < lag(ts) over (partition by user_id order by ts) + interval '12 hours' then 0 else 1 end as opens from l where not late),
  s as (select *, sum(opens) over (partition by user_id order by ts) as number from g)
  select user_id, min(ts) as started_at, max(ts) as last_event_at, count(*) as event_count, count(*) filter (event_type = 'click') as clicks
  from s group by user_id, number having max(ts) + interval '12 hours' <= (select max(ts) from l where not late) - interval '3 days'""",
)
def session_stream(t: Tables):
    """Sessions of shuffled deliveries, as gaps and islands over the events in time give them."""
    return t.spark.read.parquet(f"{_land_events(t)}/sessions").select("user_id", "started_at", "last_event_at", "event_count", "clicks")


@query("session_stream_late", f"{_DEALT_SQL} select event_id, ts from l where late")
def session_stream_late(t: Tables):
    """Events that came behind the watermark are kept, none is dropped."""
    return sessions.late_events(t.spark, _land_events(t), "event_id long, ts timestamp")


@query(
    "json_schema_grown",
    """select event_id, cast(case when event_id % 2 = 0 then floor(value) else value end as double) as amount,
       cast(json_extract_string(props, '$.k') as bigint) as props_k, case when event_id % 2 = 1 then event_type end as props_kind,
       case when event_id % 2 = 0 then cast(user_id as varchar) else 'u' || user_id end as who,
       case when event_id % 2 = 1 then event_id end as extra from events""",
)
def json_schema_grown(t: Tables):
    """Two loads of documents; the second has new, nested and wider fields, and only it is looked at then."""
    root = scratch_path(t.spark, "json-grown")
    k = F.from_json("props", "k bigint").k.alias("k")
    loads = [
        t.events.filter("event_id % 2 = 0").select(
            F.struct("event_id", F.floor("value").alias("amount"), F.struct(k).alias("props"), F.col("user_id").alias("who")).alias("d")
        ),
        t.events.filter("event_id % 2 = 1").select(
            F.struct(
                "event_id",
                F.col("value").alias("amount"),
                F.struct(k, F.col("event_type").alias("kind")).alias("props"),
                F.concat(F.lit("u"), "user_id").alias("who"),
                F.col("event_id").alias("extra"),
            ).alias("d")
        ),
    ]
    for load in loads:
        texts = load.select(F.to_json("d").alias("data"))
        schema = grow_json_schema(t.spark, texts, "data", f"{root}/schema")
        lake.append(parse_json(texts, "data", schema), f"{root}/table", widen=True)
    return flatten_structs(lake.read_lake(t.spark, f"{root}/table"))
