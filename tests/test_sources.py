from datetime import datetime

import pytest
from conftest import physical, rows
from pyspark.sql import functions as F

from tidewell.plans import jobs
from tidewell.plans.entities import ENTITIES
from tidewell.plans.steps import Context
from tidewell.session import scratch_root
from tidewell.sources import files, jdbc, lake, lineage, watermark
from test_entities import CASES

AT = datetime(2024, 5, 1, 12)
T = [datetime(2024, 1, n) for n in range(1, 6)]


def test_incremental_query():
    assert jdbc.incremental_query("users", "w", None) == "(SELECT * FROM users) t"
    stamp = datetime(2024, 1, 2, 3, 4, 5, 600)
    assert jdbc.incremental_query("users", "w", stamp) == (
        "(SELECT * FROM users WHERE w > TIMESTAMP '2024-01-02 03:04:05.000600') t"
    )
    assert " w >= TIMESTAMP" in jdbc.incremental_query("users", "w", stamp, inclusive=True)


def test_jdbc_options():
    connection = jdbc.Connection("jdbc:postgresql://h/db", "u", "secret", extra={"ssl": "true"})
    read = jdbc.read_options(connection, "t", jdbc.Slices("id", 1, 900, 16))
    assert read["partitionColumn"] == "id" and read["numPartitions"] == "16" and read["ssl"] == "true"
    assert read["driver"] == "org.postgresql.Driver" and "secret" not in repr(connection)
    write = jdbc.write_options(connection, "t", types={"name": "VARCHAR(255)"})
    assert write["batchsize"] == "1000" and write["createTableColumnTypes"] == "name VARCHAR(255)"
    assert "createTableColumnTypes" not in jdbc.write_options(connection, "t")


@pytest.fixture
def database(spark, monkeypatch):
    """Tables by name in place of a database: the reader answers the queries the
    jobs send, the writer appends."""
    tables = {}

    def read(session, connection, text, slices=None):
        name = next(n for n in sorted(tables, key=len, reverse=True) if f" {n}" in text or text == n)
        if text == name:
            return tables[name]
        tables[name].createOrReplaceTempView(name)
        inner = text[1:].rsplit(")", 1)[0]
        return session.sql(inner)

    def write(df, connection, name, **options):
        held = tables.get(name)
        written = spark.createDataFrame(df.collect(), df.schema)
        tables[name] = written if held is None else held.unionByName(written, allowMissingColumns=True)

    monkeypatch.setattr(jdbc, "read_table", read)
    monkeypatch.setattr(jdbc, "append_table", write)
    return tables


def test_copy_table(spark, database):
    database["licences"] = spark.createDataFrame([(1, T[0]), (2, T[1]), (3, T[1])], "id int, created_at timestamp")
    database["copied"] = lineage.stamp_landing(database["licences"].filter("id < 3"), "b0", AT, "licences")
    here = jdbc.Connection("jdbc:x")
    for _ in range(2):
        jobs.copy_table(spark, here, here, "licences", "copied", ["id"], "b1", at=AT)
    assert rows(database["copied"], "id", "dw_batch_id") == [(1, "b0"), (2, "b0"), (3, "b1")]


def test_jdbc_to_bronze(spark, database, tmp_path):
    bronze = f"{tmp_path}/bronze"
    database["plans"] = spark.createDataFrame([(1, T[0]), (2, T[1])], "id int, dw_ingested_at timestamp")
    connection = jdbc.Connection("jdbc:x")
    assert jobs.jdbc_to_bronze(spark, connection, "plans", bronze, "b1", at=AT) == 2
    assert jobs.jdbc_to_bronze(spark, connection, "plans", bronze, "b2", at=AT) == 0
    more = spark.createDataFrame([(3, T[2])], "id int, dw_ingested_at timestamp")
    database["plans"] = database["plans"].unionAll(more)
    assert jobs.jdbc_to_bronze(spark, connection, "plans", bronze, "b3", at=AT) == 1
    table = lake.read_lake(spark, bronze, evolving=True)
    assert rows(table, "id", "batch_id", "source_table") == [(1, "b1", "plans"), (2, "b1", "plans"), (3, "b3", "plans")]


def test_watermark(spark):
    df = spark.createDataFrame([(1, T[0]), (2, T[2]), (3, None)], "id int, w timestamp")
    assert watermark.high_watermark(None, "w") is None
    assert watermark.high_watermark(df.limit(0), "w") is None
    assert watermark.high_watermark(df, "w") == T[2]
    assert rows(watermark.rows_after(df, "w", T[0]), "id") == [(2,)]
    assert rows(watermark.rows_after(df, "w", T[0], inclusive=True), "id") == [(1,), (2,)]
    assert watermark.rows_after(df, "w", None).count() == 3
    days = df.withColumn("day", F.to_date("w"))
    assert watermark.high_watermark(days, "w", within="day") == T[2]
    assert watermark.high_watermark(days.limit(0), "w", within="day") is None
    assert watermark.watermark_frame(df.limit(0), "w", watermark.EPOCH).first()[0] == watermark.EPOCH


def test_inclusive_copy_is_idempotent(spark):
    source = spark.createDataFrame([(1, T[0]), (2, T[1]), (3, T[1]), (4, T[2])], "id int, w timestamp")
    held = source.filter("id in (1, 2)")
    fresh = watermark.rows_to_copy(source, held, "w", {"id": "id"})
    assert rows(fresh, "id") == [(3,), (4,)]
    after = held.unionAll(fresh)
    assert watermark.rows_to_copy(source, after, "w", {"id": "id"}).count() == 0
    assert watermark.rows_to_copy(source, None, "w", {"id": "id"}).count() == 4
    assert watermark.rows_to_copy(source, held.limit(0), "w", {"id": "id"}).count() == 4


def test_landing_to_bronze(spark, tmp_path):
    landing, bronze = f"{tmp_path}/landing", f"{tmp_path}/bronze"
    lake.append(lineage.stamp_landing(spark.range(3), "b1", T[0], "f"), landing)
    assert jobs.landing_to_bronze(spark, landing, bronze) > 0
    assert jobs.landing_to_bronze(spark, landing, bronze) == 0
    wider = spark.range(2).withColumn("extra", F.lit("x"))
    lake.append(lineage.stamp_landing(wider, "b2", T[1], "f"), landing)
    assert jobs.landing_to_bronze(spark, landing, bronze) > 0
    table = lake.read_lake(spark, bronze, evolving=True)
    assert table.count() == 5 and table.filter("extra = 'x'").count() == 2
    assert sorted(p.name for p in (tmp_path / "bronze").glob("dw_ingest_day=*")) == [
        "dw_ingest_day=2024-01-01", "dw_ingest_day=2024-01-02",
    ]
    assert "dw_ingest_day" not in lineage.canonical_lineage(table).columns


def test_bronze_without_day_folders_stays_so(spark, tmp_path):
    landing, bronze = f"{tmp_path}/landing", f"{tmp_path}/bronze"
    lineage.stamp_landing(spark.range(3), "b1", T[0], "f").write.parquet(bronze)
    lake.append(lineage.stamp_landing(spark.range(3), "b2", T[1], "f"), landing)
    assert jobs.landing_to_bronze(spark, landing, bronze) > 0
    assert jobs.landing_to_bronze(spark, landing, bronze) == 0
    assert lake.read_lake(spark, bronze).count() == 6


def test_appends_keep_the_schema(spark, tmp_path):
    path = f"{tmp_path}/table"
    lake.append(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    lake.append(spark.createDataFrame([(2.5, 2)], "price double, id int"), path)
    table = lake.read_lake(spark, path)
    assert table.columns == ["id", "v", "price"]
    assert rows(table) == [(1, "a", None), (2, None, 2.5)]
    with pytest.raises(ValueError, match="column id .* is int, not string"):
        lake.append(spark.createDataFrame([("x",)], "id string"), path)
    assert lake.read_lake(spark, path).count() == 2


def test_one_failure_does_not_stop_the_others(spark):
    def job(name):
        if name == "bad":
            raise RuntimeError("no such table\nmore")
        return 3 * (name == "full")

    outcomes = jobs.run_each(["full", "bad", "empty"], job)
    assert rows(jobs.outcome_table(spark, outcomes)) == [
        ("bad", "failed", "no such table", None), ("empty", "nothing new", "", 0), ("full", "loaded", "", 3),
    ]


def test_seed(spark, tmp_path):
    path = f"{tmp_path}/seed"
    seed = spark.createDataFrame([(1,), (2,)], "id int")
    jobs.seed_table(spark, seed, path, "b1", "seed.csv", T[0])
    jobs.seed_table(spark, seed.filter("id = 2"), path, "b2", "seed.csv", T[1])
    assert rows(lake.read_lake(spark, path), "id", "dw_batch_id") == [(1, "b1"), (2, "b1"), (2, "b2")]
    jobs.seed_table(spark, seed.limit(0), path, "b3", "seed.csv", T[2], restamp="all")
    assert rows(lake.read_lake(spark, path), "dw_batch_id") == [("b3",)] * 3
    with pytest.raises(ValueError):
        files.load_seed(seed, None, "b", "s", restamp="some")


def test_lineage(spark):
    stamped = lineage.stamp_landing(spark.range(1), "b", AT, "f.csv")
    assert tuple(stamped.first()) == (0, AT, "f.csv", "b")
    canonical = lineage.canonical_lineage(stamped)
    assert canonical.columns == ["id", "ingest_time", "source_identifier", "batch_id"]
    both = lineage.canonical_lineage(stamped.withColumn("ingest_time", F.lit(None).cast("timestamp")))
    assert both.first().ingest_time == AT
    bare = lineage.canonical_lineage(spark.range(1))
    assert bare.first().ingest_time is None and dict(bare.dtypes)["ingest_time"] == "timestamp"
    assert lineage.drop_technical(canonical).columns == ["ingest_time"]


def test_monthly_csv(spark, tmp_path):
    path = tmp_path / "csv"
    df = spark.createDataFrame([(1, "2024-01-31"), (2, "2024-02-01"), (3, "2024-02-29")], "id int, created_at string")
    lake.write_monthly_csv(df, str(path))
    january = sorted(p.name for p in path.glob("year=2024/month=1/*.csv"))
    lake.write_monthly_csv(df.filter("id = 2"), str(path))
    assert sorted(p.name for p in path.glob("year=2024/month=1/*.csv")) == january
    stored = spark.read.option("header", True).csv(str(path))
    assert rows(stored, "id") == [("1",), ("2",)]
    header = next(path.glob("year=2024/month=2/*.csv")).read_text().splitlines()[0]
    assert header == "id,created_at"
    with pytest.raises(ValueError):
        lake.write_monthly_csv(df.drop("created_at"), str(path))


def test_overwritten_file_is_read_again(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("id,v\n1,x\n")
    (folder / "b.csv").write_text("id,v\n2,y\n")
    schema = "id int, v string"
    first = files.changed_files(spark, str(folder), schema)
    assert rows(first, "id", "v") == [(1, "x"), (2, "y")]
    mark = first.agg(F.max("changed_at")).first()[0]
    import os
    (folder / "a.csv").write_text("id,v\n1,z\n3,w\n")
    later = mark.timestamp() + 5
    os.utime(folder / "a.csv", (later, later))
    assert rows(files.changed_files(spark, str(folder), schema, mark), "id", "v") == [(1, "z"), (3, "w")]


def test_csv_set_skips_unreadable_and_undescribed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Ticket Description,Type\nhello,bug\n")
    (tmp_path / "b.csv").write_text("n,long_description\n1,world\n")
    (tmp_path / "c.csv").write_text("n,m\n1,2\n")
    found = files.ticket_texts(files.read_csv_set(spark, [f"{tmp_path}/{n}.csv" for n in "abc"]))
    assert rows(found) == [("hello", "bug"), ("world", None)]
    with pytest.raises(ValueError):
        files.ticket_texts(files.read_csv_set(spark, [f"{tmp_path}/c.csv"]))


def test_publish_is_idempotent(spark, tmp_path):
    case, plan = CASES["subscriptions"], ENTITIES["subscriptions"]
    target, quarantine = f"{tmp_path}/silver", f"{tmp_path}/quarantine"
    results = []
    for _ in range(2):
        report = jobs.publish(spark, plan, case.raw(spark), case.context(spark), target, quarantine, "b1", buckets=2)
        results.append((rows(report), rows(lake.read_lake(spark, target)), lake.read_lake(spark, quarantine).count()))
    assert results[0] == results[1]


def test_whole_chain(spark, tmp_path):
    """All ten entities from bronze, each checked against the tables before it."""
    root = str(tmp_path)
    for name, case in CASES.items():
        lake.overwrite(case.raw(spark).drop("source_identifier"), f"{root}/bronze/{name}")
    outcomes = jobs.curate_all(spark, root, "b1", AT.date(), buckets=2)
    assert [o.status for o in outcomes] == ["loaded"] * 10, outcomes
    tables = jobs.curated_tables(spark, root)
    assert set(tables) == set(ENTITIES)
    orphans = tables["payments"].join(tables["subscriptions"], "subscription_id", "left_anti")
    assert orphans.count() == 0 and tables["payments"].count() > 0
    assert lake.read_lake(spark, f"{root}/quality/payments").count() > 2


def test_a_second_run_reads_the_new_days_only(spark, tmp_path):
    bronze = f"{tmp_path}/bronze"
    stamped = spark.createDataFrame([(1, T[0]), (2, T[1]), (3, T[2]), (4, None)], "id int, w timestamp")
    lake.append(stamped.withColumn(lineage.INGEST_DAY, F.to_date("w")), bronze, by=[lineage.INGEST_DAY])
    assert [str(d) for d in jobs.ingest_days(spark, bronze)] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    since = jobs.rows_since(lake.read_lake(spark, bronze), "2024-01-02")
    assert rows(since, "id") == [(2,), (3,), (4,)]
    assert "PartitionFilters: [((dw_ingest_day" in physical(since)


def test_late_ties_and_rows_without_a_stamp_arrive(spark, tmp_path):
    landing, bronze = f"{tmp_path}/landing", f"{tmp_path}/bronze"
    for ids, stamp in (([1, 2], T[0]), ([3, 4], T[0]), ([5], None), ([6], None), ([7], T[1])):
        lake.append(spark.createDataFrame([(n, stamp) for n in ids], "id int, dw_ingested_at timestamp"), landing)
        assert jobs.landing_to_bronze(spark, landing, bronze) == len(ids)
        assert jobs.landing_to_bronze(spark, landing, bronze) == 0
    assert sorted(r.id for r in lake.read_lake(spark, bronze).collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_a_broken_copy_loses_no_rows(spark, database, tmp_path):
    database["licences"] = spark.createDataFrame([(n, T[n % 3]) for n in range(9)], "id int, created_at timestamp")
    # the broken copy wrote some of the newest rows only
    database["copied"] = lineage.stamp_landing(database["licences"].filter("id in (2, 5)"), "b0", AT, "licences")
    here, state = jdbc.Connection("jdbc:x"), f"{tmp_path}/state"
    for _ in range(2):
        jobs.copy_table(spark, here, here, "licences", "copied", ["id"], "b1", at=AT, state=state)
    assert rows(database["copied"], "id") == [(n,) for n in range(9)]
    assert lake.load_mark(spark, state) == T[2].isoformat()


def test_timestamps_for_sql_server():
    text = jdbc.incremental_query("u", "w", datetime(2024, 1, 2, 3), inclusive=True, url="jdbc:sqlserver://h")
    assert "CAST('2024-01-02T03:00:00' AS datetime2)" in text and "w IS NULL" in text


def test_scratch_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir", scratch_root(spark))


def test_held_rows_are_not_sent_to_the_driver(spark):
    """Digests of rows that compress well look small to Spark and are many."""
    at = datetime(2024, 1, 1)
    held = spark.range(1000).select("id", F.lit(at).alias("at"))
    found = watermark.rows_not_held(spark.range(1002).select("id", F.lit(at).alias("at")), held, "at", at)
    assert "Broadcast" not in physical(found)
    assert rows(found) == [(1000, at), (1001, at)]
