import json
from datetime import datetime

import pytest
from conftest import physical, rows

from tidewell.operators import upsert
from tidewell.operators.quality import Rule, required
from tidewell.operators.references import Reference
from tidewell.plans import jobs, replay
from tidewell.plans.entity import REFUSED, EntityPlan
from tidewell.plans.steps import Check, Context, References, Typed
from tidewell.sources import lake

PLAN = EntityPlan(
    "orders",
    columns=["id", "user_id", "plan_id", "amount", "ingest_time"],
    steps=[
        Typed({"id": "int", "user_id": "int", "plan_id": "int", "amount": "decimal(10,2)", "ingest_time": "timestamp"}),
        Check([required("id")]),
        References([Reference("users", {"user_id": "user_id"}, "no user"), Reference("plans", {"plan_id": "plan_id"}, "no plan")]),
        Check([Rule("positive", "amount > 0", "amount not positive")]),
    ],
    merge_keys=["id"],
    newest=["ingest_time"],
)
SCHEMA = "id string, user_id int, plan_id int, amount double, ingest_time timestamp"


def at(day):
    return datetime(2024, 1, day, 3, 4, 5, 678901)


RAW = [
    ("1", 1, 1, 5.0, at(1)),  # fine
    ("2", 2, 1, 5.25, at(1)),  # user late
    ("3", 2, 2, 5.0, at(1)),  # user and plan late
    ("4", 3, 1, 5.0, at(1)),  # user never comes
    ("5", 2, 1, -5.0, at(1)),  # user late, then the amount is wrong
    (None, 2, 1, 5.0, at(1)),  # rejected before its references
    ("6", 2, 1, 5.0, at(1)), ("6", 2, 1, 6.0, at(2)),  # the newer one counts
    ("7", 2, 1, 1.0, at(1)), ("7", 1, 1, 2.0, at(2)),  # a newer row is stored already
    ("8", 2, 1, 8.0, at(1)), ("8", 2, 1, 8.0, at(1)),  # copies
]


class Shop:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.raw = spark.createDataFrame(RAW, SCHEMA)

    def add(self, table, *ids):
        key = f"{table[:-1]}_id"
        frame = self.spark.createDataFrame([(n,) for n in ids], f"{key} int")
        upsert.upsert_path(self.spark, f"{self.root}/silver/{table}", frame, [key], buckets=4)

    def context(self):
        return Context({t: lake.read_lake(self.spark, f"{self.root}/silver/{t}").drop(lake.BUCKET) for t in ("users", "plans")})

    def publish(self, raw, batch):
        place = f"{self.root}/silver/orders", f"{self.root}/quarantine/orders"
        return jobs.publish_accounted(self.spark, PLAN, raw, self.context(), *place, batch, buckets=2)

    def replay(self, batch):
        return replay.replay_entity(self.spark, PLAN, self.raw, self.context(), self.root, batch, 2)

    def stored(self):
        return rows(lake.read_lake(self.spark, f"{self.root}/silver/orders"), "id", "amount", "ingest_time")

    def kept(self):
        found = self.spark.read.parquet(f"{self.root}/quarantine/orders").collect()
        return sorted((json.loads(r.payload).get("id") or 0, r.reason, r.batch_id) for r in found)


@pytest.fixture
def shop(spark, tmp_path):
    shop = Shop(spark, tmp_path)
    shop.add("users", 1)
    shop.add("plans", 1)
    shop.publish(shop.raw, "b1")
    shop.replay("b1")
    return shop


def ids(found):
    return [r[0] for r in found]


def test_rows_wait_for_all_their_keys(shop):
    assert ids(shop.stored()) == [1, 7]
    before = shop.kept()
    assert shop.replay("idle").judged == 0 and shop.kept() == before
    shop.add("users", 2, 9)
    done = shop.replay("b2")
    assert done.judged == 8
    assert (done.merged.inserted, done.merged.refused) == (3, 1)
    stored = {r[0]: r[1:] for r in shop.stored()}
    assert sorted(stored) == [1, 2, 6, 7, 8]
    assert [float(stored[n][0]) for n in (2, 6, 7, 8)] == [5.25, 6.0, 2.0, 8.0]
    assert stored[2][1] == at(1), "microseconds stay"
    kept = shop.kept()
    assert (3, "no plan", "b1") in kept and (4, "no user", "b1") in kept and (5, "amount not positive", "b1") in kept
    assert (7, REFUSED, "replay-b2") in kept
    assert [k[:2] for k in kept if k[0] in (6, 8)] == [(6, "superseded by a newer row of the key"), (8, "superseded by a newer row of the key")]
    # every raw row is stored or kept
    assert len(stored) + len(kept) == len(RAW)
    shop.add("plans", 2)
    assert shop.replay("b3").merged.inserted == 1
    assert ids(shop.stored()) == [1, 2, 3, 6, 7, 8]
    assert len(shop.stored()) + len(shop.kept()) == len(RAW)
    assert shop.replay("b4").judged == 0


def test_an_interrupted_replay_may_be_repeated(shop, monkeypatch):
    shop.add("users", 2)
    with monkeypatch.context() as patched:
        patched.setattr(replay, "union_all", lambda frames: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            shop.replay("b2")
    assert ids(shop.stored()) == [1, 2, 6, 7, 8]
    done = shop.replay("b2")
    assert (done.judged, done.merged.inserted, done.merged.repeated) == (8, 0, 3)
    assert ids(shop.stored()) == [1, 2, 6, 7, 8]
    assert len(shop.stored()) + len(shop.kept()) == len(RAW)


def test_a_batch_without_rows_left_is_gone(spark, tmp_path):
    shop = Shop(spark, tmp_path)
    shop.add("users", 1)
    shop.add("plans", 1)
    shop.publish(shop.raw.filter("id = '2'"), "b 1/x")
    shop.publish(shop.raw.filter("id = '4'"), "b2")
    shop.replay("b2")
    shop.add("users", 2)
    assert shop.replay("b3").judged == 1
    assert shop.kept() == [(4, "no user", "b2")] and ids(shop.stored()) == [2]


def test_only_changed_buckets_of_a_reference_are_read(shop, spark):
    path = f"{shop.root}/silver/users"
    version = lake.current_load(spark, path).version
    assert replay.arrived_rows(spark, path, version) is None
    shop.add("users", *range(100, 104))
    arrived = replay.arrived_rows(spark, path, version)
    assert {100, 101, 102, 103} <= set(ids(rows(arrived)))
    upsert.vacuum(spark, path)
    assert len(rows(replay.arrived_rows(spark, path, version))) == 5, "without the old state all rows count"


def test_curation_replays_by_itself(spark, tmp_path):
    from test_entities import CASES

    root = str(tmp_path)
    for name in ("products", "plans", "users", "subscriptions"):
        lake.overwrite(CASES[name].raw(spark).drop("source_identifier"), f"{root}/bronze/{name}")
    late = lake.read_lake(spark, f"{root}/bronze/users")
    jobs.curate_all(spark, root, "b0", names=["products", "plans"], buckets=2)
    upsert.upsert_path(spark, f"{root}/silver/users", spark.createDataFrame([(-1,)], "user_id long"), ["user_id"], buckets=2)
    jobs.curate_all(spark, root, "b1", names=["subscriptions"], buckets=2)
    assert lake.read_lake(spark, f"{root}/silver/subscriptions").count() == 0
    everyone = late.selectExpr("try_cast(user_id as long) as user_id").filter("user_id is not null").distinct()
    upsert.upsert_path(spark, f"{root}/silver/users", everyone, ["user_id"], buckets=2)
    outcomes = jobs.curate_all(spark, root, "b2", names=["subscriptions"], buckets=2)
    assert outcomes[0].status == "loaded" and lake.read_lake(spark, f"{root}/silver/subscriptions").count() > 0


def test_no_task_reads_a_whole_batch_of_the_quarantine(spark, conf):
    """What stays in the quarantine is found by row, also where no side is small."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    schema = "batch_id string, reason string, payload string"
    whole = spark.createDataFrame([("b", "r", str(n % 50)) for n in range(100)] + [("c", "r", "1")], schema)
    candidates = whole.filter("batch_id = 'b' and payload < '3'")
    staying = replay._staying(whole, candidates)
    assert "SortMergeJoin [batch_id" not in physical(staying)
    assert rows(staying) == rows(whole.filter("batch_id = 'b' and payload >= '3'"))
