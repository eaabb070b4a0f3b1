from conftest import physical, rows
from pyspark.sql import functions as F

from tidewell.operators.dedup import latest, mark_latest, split_latest, superseded

SCHEMA = "k int, d string, v string, t int"
DATA = [
    (1, "a", "old", 1),
    (1, "a", "new", 2),
    (1, "b", "only", 1),
    (2, "a", "tie-x", 5),
    (2, "a", "tie-y", 5),
    (3, "a", "null-stamp", None),
    (3, "a", "stamped", 0),
    (None, "a", "n1", 1),
    (None, "a", "n2", 2),
]


def test_latest_wins_and_nulls_lose(spark):
    kept = latest(spark.createDataFrame(DATA, SCHEMA), ["k", "d"], ["t"])
    assert {r.v for r in kept.collect()} == {"new", "only", "tie-x", "stamped", "n2"}


def test_split_conserves_rows(spark):
    df = spark.createDataFrame(DATA * 3, SCHEMA).repartition(5)
    kept, dropped = split_latest(df, ["k", "d"], ["t"])
    assert rows(kept.unionAll(dropped)) == rows(df)
    assert kept.count() == 5


def test_ties_do_not_depend_on_layout(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    first = rows(latest(df.repartition(1), ["k", "d"], ["t"]))
    assert first == rows(latest(df.orderBy(F.desc("v")).repartition(7), ["k", "d"], ["t"]))
    marked = mark_latest(df.repartition(4), ["k", "d"], ["t"], "keep")
    assert first == rows(marked.filter("keep").drop("keep"))


def test_group_of_copies(spark, conf):
    """A third of all rows are copies of one row: one is kept, all others are
    dropped, and no task ranks them all."""
    hot = spark.range(20_000).select(F.lit(7).alias("k"), F.lit(1).alias("t"))
    cold = spark.range(40_000).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("t"))
    df = hot.unionAll(cold).repartition(16)
    dropped = superseded(df, ["k"], ["t"])
    assert dropped.count() == 20_000
    assert dropped.filter("k <> 7").count() == 0
    assert latest(df, ["k"], ["t"]).count() == 40_000
    marked = mark_latest(df, ["k"], ["t"], "keep")
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    sizes = marked.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 20_000, "the copies are ranked by several tasks"


def test_contest_among_some_rows(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    marked = mark_latest(df, ["k", "d"], ["t"], "keep", among=F.col("v") != "new")
    kept = {r.v for r in marked.filter("keep").collect()}
    assert "old" in kept and "new" not in kept


def test_latest_limits_before_the_shuffle(spark):
    plan = physical(latest(spark.createDataFrame(DATA, SCHEMA), ["k", "d"], ["t"]))
    before, after = plan.split("Exchange")[0], plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before and "Partial" in after
