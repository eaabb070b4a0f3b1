from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators.nested import grow_json_schema, parse_json
from tidewell.sources import lake
from tidewell.streaming import sessions

T0 = datetime(2024, 1, 1)
SCHEMA = "user int, ts timestamp, n int"


def minutes(n):
    return T0 + timedelta(minutes=n)


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root, self.sent = spark, str(root), 0

    def send(self, *events):
        frame = self.spark.createDataFrame([(u, None if m is None else minutes(m), n) for u, m, n in events], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/in")
        sessions.land_sessions(
            stream, f"{self.root}/out", ["user"], "ts", timedelta(minutes=10), timedelta(minutes=30), [F.sum("n").alias("total")]
        )

    def sessions(self):
        found = self.spark.read.parquet(f"{self.root}/out/sessions")
        return rows(found, "user", "started_at", "last_event_at", "event_count", "total")

    def late(self):
        return [r[0] for r in rows(sessions.late_events(self.spark, f"{self.root}/out", StructType.fromDDL(SCHEMA)), "n")]


def test_sessions_close_and_late_events_are_kept(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.send((1, 0, 1), (1, 8, 2), (2, 3, 4), (1, 30, 8))
    assert feed.sessions() == [] and feed.late() == []
    # in time although older than what came before: it joins two sessions into one
    feed.send((1, 16, 16), (1, 24, 32), (None, 5, 64), (3, None, 128))
    assert feed.sessions() == [] and feed.late() == [128]
    feed.send((2, 100, 256))
    assert feed.sessions() == [
        (1, minutes(0), minutes(30), 5, 59), (2, minutes(3), minutes(3), 1, 4), (None, minutes(5), minutes(5), 1, 64),
    ]
    feed.send((1, 69, 512), (1, 71, 1024), (2, 108, 2048))
    assert feed.late() == [128, 512]
    feed.send((9, 1000, 0))
    assert feed.sessions()[1:4] == [(1, minutes(71), minutes(71), 1, 1024), (2, minutes(3), minutes(3), 1, 4), (2, minutes(100), minutes(108), 2, 2304)]


def test_a_repeated_micro_batch_deals_as_before(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.send((1, 0, 1), (1, 100, 2))
    feed.send((1, 60, 4), (1, 99, 8))
    marks = f"{tmp_path}/out/marks"
    first, second = (sessions._watermark_before(spark, marks, n) for n in (1, 2))
    assert (first, second) == (minutes(70), minutes(70)) and sessions._watermark_before(spark, marks, 0) is None
    assert feed.late() == [4]


def documents(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "data string")


LOADS = [
    ('{"a": 1, "b": {"x": 1}, "l": [1], "n": null}', '{"a": 2}'),
    ('{"a": 2.5, "b": {"x": 2, "y": "z"}, "l": [{"q": 1}], "c": true}', "not json", None),
    ('{"a": "text", "n": {"deep": [null]}, "c": 1, "l": []}',),
]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2)])
def test_json_schemas_grow_whatever_the_order(spark, tmp_path, order):
    store, table = f"{tmp_path}/schema", f"{tmp_path}/table"
    for n in order:
        load = documents(spark, *LOADS[n])
        schema = grow_json_schema(spark, load, "data", store)
        lake.append(parse_json(load, "data", schema), table, widen=True)
    kinds = {f.name: f.dataType.simpleString() for f in lake.read_lake(spark, table).schema.fields}
    assert kinds == {
        "a": "string", "b": "struct<x:bigint,y:string>", "c": "string", "l": "array<string>", "n": "struct<deep:array<string>>",
    }
    found = lake.read_lake(spark, table).select("a", "b.x", "b.y", "n.deep", "c")
    assert found.count() == 6
    assert rows(found.filter("b is not null"), "x", "y") == [(1, None), (2, "z")]
    assert sorted(r.a for r in found.collect() if r.a) in (["1", "2", "2.5", "text"], ["1.0", "2.0", "2.5", "text"])


def test_an_equal_load_stores_no_schema(spark, tmp_path):
    store = f"{tmp_path}/schema"
    load = documents(spark, '{"a": 1}')
    assert grow_json_schema(spark, load, "data", store) == grow_json_schema(spark, load, "data", store)
    assert spark.read.json(store).count() == 1
    assert grow_json_schema(spark, documents(spark), "data", store).names == ["a"]
