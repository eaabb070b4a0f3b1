from datetime import datetime

import pytest
from conftest import physical, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewell.operators import upsert as u

T = [datetime(2024, 1, n) for n in range(1, 6)]
SCHEMA = "k int, v string, t timestamp"
TARGET = [(1, "t1", T[2]), (2, "t2", T[2]), (3, "t3", T[2]), (4, "t4", None), (5, "t5", T[2]), (None, "t-null", T[0])]
BATCH = [(1, "older", T[1]), (2, "equal", T[2]), (3, "newer", T[3]), (4, "to-null", T[4]), (5, "null", None),
         (6, "insert", T[0]), (None, "b-null", T[4])]


def merged(spark, target, batch, newer_than="t"):
    target, batch = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA)
    return rows(u.merge_frames(target, batch, ["k"], newer_than), "k", "v")


def test_newer_only(spark):
    assert merged(spark, TARGET, BATCH) == sorted(
        [(1, "t1"), (2, "t2"), (3, "newer"), (4, "t4"), (5, "t5"), (6, "insert"), (None, "t-null"), (None, "b-null")],
        key=repr,
    )


def test_always(spark):
    assert merged(spark, TARGET, BATCH, None) == sorted(
        [(1, "older"), (2, "equal"), (3, "newer"), (4, "to-null"), (5, "null"), (6, "insert"),
         (None, "t-null"), (None, "b-null")],
        key=repr,
    )


def test_composite_key(spark):
    schema = "a int, b int, v string, t int"
    target = spark.createDataFrame([(1, 1, "x", 1), (1, 2, "y", 1)], schema)
    batch = spark.createDataFrame([(1, 1, "new", 2), (2, 1, "add", 1)], schema)
    out = u.merge_frames(target, batch, ["a", "b"], "t")
    assert rows(out, "a", "b", "v") == [(1, 1, "new"), (1, 2, "y"), (2, 1, "add")]


row = st.tuples(st.integers(1, 6), st.text("xyz", max_size=2), st.sampled_from([None, *T]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=8, unique_by=lambda r: r[0]), st.lists(row, max_size=8, unique_by=lambda r: r[0]))
def test_merge_properties(spark, target, batch):
    """Repeating a batch changes nothing, keys stay unique."""
    t, b = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA)
    expected = {k: (k, v, s) for k, v, s in target}
    for k, v, s in batch:
        held = expected.get(k)
        if held is None or (s is not None and held[2] is not None and s > held[2]):
            expected[k] = (k, v, s)
    once = u.merge_frames(t, b, ["k"], "t")
    assert rows(once) == sorted(expected.values(), key=repr)
    assert rows(u.merge_frames(once, b, ["k"], "t")) == rows(once)


def test_outer_join_spreads_missing_keys(spark):
    df = spark.createDataFrame(TARGET, SCHEMA)
    assert "__lane" in physical(u.merge_frames(df, df, ["k"])).split("Exchange")[1]


def test_stored_table_rewrites_touched_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/table"
    first = spark.createDataFrame([(n, f"v{n}", T[0]) for n in range(50)], SCHEMA)
    u.upsert_path(spark, path, first, ["k"], "t", buckets=8)
    before = u.current_load(spark, path).loads
    batch = spark.createDataFrame([(7, "new", T[1])], SCHEMA)
    u.upsert_path(spark, path, batch, ["k"], "t")
    after = u.current_load(spark, path).loads
    assert sum(before[b] != after[b] for b in before) == 1 and len(list((tmp_path / "table").glob("load=*/merge_bucket=*"))) == len(before) + 1
    u.upsert_path(spark, path, batch, ["k"], "t")
    stored = u.read_lake(spark, path)
    assert stored.count() == 50 and stored.filter("k = 7").first().v == "new"
    u.upsert_path(spark, path, batch.limit(0), ["k"], "t", buckets=8)
    assert u.read_lake(spark, path).count() == 50
    assert u.vacuum(spark, path) == 1 and u.read_lake(spark, path).count() == 50


def test_bucket_count_is_kept_with_the_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    batch = spark.createDataFrame([(n, "v", T[0]) for n in range(100)], SCHEMA)
    u.upsert_path(spark, path, batch, ["k"], "t", buckets=16)
    with pytest.raises(ValueError, match="16 buckets"):
        u.upsert_path(spark, path, batch, ["k"], "t", buckets=25)
    u.rebucket(spark, path, 25)
    u.upsert_path(spark, path, batch, ["k"], "t", buckets=25)
    u.upsert_path(spark, path, batch, ["k"], "t")
    assert u.read_lake(spark, path).count() == 100


def test_a_batch_may_repeat_keys_and_bring_columns(spark, tmp_path):
    path = f"{tmp_path}/table"
    u.upsert_path(spark, path, spark.createDataFrame([(1, "a", T[0]), (2, "b", T[0])], SCHEMA), ["k"], "t")
    again = spark.createDataFrame(
        [(1, "x", T[1], 7), (1, "y", T[2], 8), (3, "z", T[1], 9), (None, "n", T[1], 1), (None, "n", T[1], 1)], SCHEMA + ", extra int"
    )
    u.upsert_path(spark, path, again, ["k"], "t")
    assert rows(u.read_lake(spark, path), "k", "v", "extra") == rows(
        spark.createDataFrame([(1, "y", 8), (2, "b", None), (3, "z", 9), (None, "n", 1), (None, "n", 1)], "k int, v string, extra int")
    )
    # a batch that lacks a column leaves it as it is
    u.upsert_path(spark, path, spark.createDataFrame([(1, "w", T[3])], SCHEMA), ["k"], "t")
    assert u.read_lake(spark, path).filter("k = 1").first().extra == 8


def test_table_may_start_empty(spark, tmp_path):
    path = f"{tmp_path}/table"
    batch = spark.createDataFrame(BATCH[:3], SCHEMA)
    u.upsert_path(spark, path, batch.limit(0), ["k"], "t", buckets=4)
    assert u.read_lake(spark, path).count() == 0
    u.upsert_path(spark, path, batch, ["k"], "t", buckets=4)
    assert rows(u.read_lake(spark, path), "k", "v") == [(1, "older"), (2, "equal"), (3, "newer")]


def test_merge_into_needs_a_row_level_catalog(spark):
    spark.createDataFrame(TARGET, SCHEMA).write.mode("overwrite").saveAsTable("merge_target")
    with pytest.raises(Exception, match="MERGE"):
        u.merge_into(spark.createDataFrame(BATCH, SCHEMA), "merge_target", ["k"], "t")
    spark.sql("drop table merge_target")


def test_a_merge_tells_what_became_of_every_row(spark, tmp_path):
    path = f"{tmp_path}/table"
    schema = "k int, t int, v string, m map<string,string>"
    first = spark.createDataFrame([(1, 5, "a", {"x": "1"}), (2, 5, "b", None), (3, 5, "c", None), (None, 1, "n", None)], schema)
    told = u.upsert_path(spark, path, first, ["k"], "t", buckets=3)
    assert (told.inserted, told.updated, told.repeated, told.refused) == (4, 0, 0, 0)
    assert told.refused_frame(spark, path) is None
    second = spark.createDataFrame(
        [(1, 5, "a", {"x": "1"}), (2, 6, "newer", None), (3, 4, "older", None), (4, 1, "new", None), (None, 2, "n", None)], schema
    )
    told = u.upsert_path(spark, path, second, ["k"], "t")
    assert (told.inserted, told.updated, told.repeated, told.refused) == (2, 1, 1, 1)
    assert rows(told.refused_frame(spark, path), "k", "t", "v") == [(3, 4, "older")]
    assert rows(u.read_lake(spark, path), "k", "v") == [
        (1, "a"), (2, "newer"), (3, "c"), (4, "new"), (None, "n"), (None, "n"),
    ]
    # without a stamp every match updates; a batch without a column leaves it as it is
    third = spark.createDataFrame([(1, 0), (9, 0)], "k int, t int")
    told = u.upsert_path(spark, path, third, ["k"])
    assert (told.inserted, told.updated, told.stored) == (1, 1, 2)
    assert rows(u.read_lake(spark, path).filter("k in (1, 9)"), "k", "t", "v") == [(1, 0, "a"), (9, 0, None)]


def test_only_the_newest_state_is_read_and_kept(spark, tmp_path):
    path = f"{tmp_path}/table"
    for n in range(4):
        u.upsert_path(spark, path, spark.createDataFrame([(1, n)], "k int, t int"), ["k"], "t", buckets=2)
    states = sorted((tmp_path / "table" / "_loads").iterdir())
    assert len(states) == 4
    # a state that was never finished is passed over
    (tmp_path / "table" / "_loads" / "state=000000000099").mkdir()
    assert rows(u.read_lake(spark, path), "k", "t") == [(1, 3)]
    u.vacuum(spark, path)
    assert sorted(s.name for s in (tmp_path / "table" / "_loads").iterdir())[0] == states[-1].name
    assert rows(u.read_lake(spark, path), "k", "t") == [(1, 3)]
