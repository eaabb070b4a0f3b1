import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.operators import business as b
from tidewell.operators import keys, metrics


@pytest.fixture
def skewed(spark):
    """A third of the rows belong to key 1; sequence numbers are far from even."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") * F.col("id")).alias("seq"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"),
    ).repartition(6)


def test_surrogate_keys_are_contiguous(skewed):
    numbered = keys.surrogate_keys(skewed, ["seq"], "n", start_after=10)
    assert rows(numbered, "n") == sorted([(n,) for n in range(11, 3011)], key=repr)
    expected = skewed.withColumn("n", F.row_number().over(Window.orderBy("seq")) + 10)
    assert rows(numbered, "seq", "n") == rows(expected, "seq", "n")


def test_one_moment_may_hold_a_third_of_the_rows(spark, conf):
    """Ties in the first column are cut by the next one."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("at"), "id")
    numbered = keys.surrogate_keys(df.repartition(6), ["at", "id"], "n")
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("at", "id")))
    assert rows(numbered) == rows(expected)
    cut = df.repartitionByRange("at", "id").groupBy(F.spark_partition_id()).count()
    assert cut.agg(F.max("count")).first()[0] < 3000


def test_copies_get_different_numbers(spark):
    df = spark.range(100).select(F.lit("x").alias("v"))
    assert rows(keys.surrogate_keys(df, ["v"], "n"), "n") == sorted([(n,) for n in range(1, 101)], key=repr)
    assert keys.surrogate_keys(df.limit(0), ["v"], "n").count() == 0


def test_previous_value_equals_lag(skewed):
    got = keys.previous_value(skewed, ["k"], ["seq"], "v", "p")
    expected = skewed.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("seq")))
    assert rows(got) == rows(expected)


def test_previous_value_of_null_key_and_order(spark):
    data = [(None, 1, "a"), (None, 2, "b"), (1, None, "c"), (1, 5, None), (1, 6, "e")]
    df = spark.createDataFrame(data, "k int, o int, v string")
    got = keys.previous_value(df, ["k"], ["o"], "v", "p")
    assert rows(got, "k", "o", "p") == sorted(
        [(None, 1, None), (None, 2, "a"), (1, None, None), (1, 5, "c"), (1, 6, None)], key=repr
    )


def test_pages(spark):
    df = spark.range(12).withColumnRenamed("id", "n")
    paged = keys.paginate(df, ["n"], 5)
    assert [r["count"] for r in paged.groupBy("page").count().orderBy("page").collect()] == [5, 5, 2]
    assert rows(keys.one_page(df, ["n"], 5, 5)) == sorted([(n,) for n in range(5, 10)], key=repr)


def test_seats(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, None), (4, -2), (5, 2500)], "license_id int, used int")
    seats = b.expand_seats(df, "used")
    assert seats.filter("license_id = 1").count() == 3
    big = seats.filter("license_id = 5")
    assert big.count() == 2500 and big.agg(F.max("seat_number"), F.countDistinct("seat_number")).first() == (2500, 2500)
    assert set(r.license_id for r in seats.select("license_id").distinct().collect()) == {1, 5}


def test_seat_rules(spark):
    licences = spark.createDataFrame([(1, 2), (2, None)], "license_id int, max_seats int")
    allocations = spark.createDataFrame(
        [(1, 1, "active"), (1, 2, "active"), (1, 3, "deactivated"), (2, 1, "active"), (9, 1, "active"), (1, None, "active")],
        "license_id int, seat_number int, status string",
    )
    checked = b.seats_in_range(allocations, licences)
    assert rows(checked, "license_id", "seat_number", "seat_exists") == sorted(
        [(1, 1, True), (1, 2, True), (1, 3, False), (2, 1, False), (1, None, False)], key=repr
    )
    used = rows(b.seat_utilisation(licences, allocations), "license_id", "active_seats", "is_fully_used")
    assert used == [(1, 2, True), (2, 1, None)]


def test_risk(spark):
    subs = spark.createDataFrame([(1, 1, "active"), (2, 2, "active"), (3, 3, "cancelled"), (4, None, "active")],
                                 "subscription_id int, user_id int, status string")
    tickets = spark.createDataFrame([(1, "billing"), (1, "billing"), (2, "technical"), (3, "cancellation"), (2, "cancellation")],
                                    "user_id int, category string")
    payments = spark.createDataFrame([(2, "success"), (3, "failed"), (4, "refunded")], "subscription_id int, payment_status string")
    assert rows(b.risky_users(tickets)) == [(1,), (2,), (3,)]
    assert rows(b.problem_subscriptions(payments)) == [(3,), (4,)]
    marked = b.mark_churn_risk(subs, tickets.filter("user_id = 1"), payments)
    assert rows(marked, "subscription_id", "at_risk") == [(1, True), (2, False), (3, True), (4, True)]
    assert rows(b.unlinked_cancellations(tickets, subs), "user_id") == [(2,)]
    assert rows(b.linked_cancellations(tickets, subs), "user_id") == [(3,)]


def test_sessions(spark):
    events = spark.createDataFrame(
        [("s", "login", 1), ("s", "content_view", 2), ("s", "session_end", 9), ("t", "content_view", 4), (None, "login", 1)],
        "session_id string, event_type string, event_at int",
    )
    got = rows(b.sessions(events, ["session_id"]))
    assert ("s", 1, 9, 1, 9, 3, 1, 1) in got and ("t", None, None, 4, 4, 1, 0, 0) in got


def test_churn_by_month(spark):
    subs = spark.createDataFrame(
        [("2024-01-05", None), ("2024-01-05", "2024-02-10"), ("2024-02-01", "2024-02-20"), ("2024-02-01", "2024-03-01")],
        "s string, e string",
    ).selectExpr("cast(s as date) start_date", "cast(e as date) end_date")
    got = {str(r.month): tuple(r)[1:] for r in metrics.churn_by_month(subs).collect()}
    assert got["2024-01-01"] == (0, 0, None, None)
    assert got["2024-02-01"] == (2, 1, 0.5, 0.5)
    assert got["2024-03-01"] == (2, 1, 0.5, 0.5)


def test_quiet_months_have_a_row(spark):
    subs = spark.sql("select date'2024-01-10' start_date, date'2024-04-02' end_date")
    assert [str(r.month)[:7] for r in metrics.churn_by_month(subs).orderBy("month").collect()] == ["2024-01", "2024-02", "2024-03", "2024-04"]


def test_ties_are_cut_evenly(spark, conf):
    """A third of the rows tie in the whole order and still lie in several pieces."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("at")).repartition(6)
    numbered = keys.surrogate_keys(df, ["at"], "n")
    assert numbered.filter("at = 5").groupBy(F.col("n") % 1).count().first()[1] == 3001
    tie = F.xxhash64(F.monotonically_increasing_id())
    pieces = df.withColumn("t", tie).repartitionByRange("at", "t").groupBy(F.spark_partition_id()).count()
    assert pieces.agg(F.max("count")).first()[0] < 3600


def test_net_retention(spark):
    user_revenue = spark.sql(
        """select * from values (1, date'2024-01-01', 10.0), (2, date'2024-01-01', 30.0), (1, date'2024-02-01', 15.0),
           (3, date'2024-02-01', 99.0) as t(user_id, month, mrr)"""
    )
    got = {str(r.month): (float(r.starting_mrr), float(r.retained_mrr), r.cohort_users, r.retained_users)
           for r in metrics.net_retention(user_revenue).collect()}
    assert got["2024-02-01"] == (40.0, 15.0, 2, 1)
    assert got["2024-03-01"] == (114.0, 0.0, 2, 0)
