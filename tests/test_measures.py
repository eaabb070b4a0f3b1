import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators import business, metrics, models, sketches

T0 = datetime(2024, 1, 1)


def sweep(data):
    """Most seats at once per licence and the first moment of it, event by event."""
    moves = defaultdict(lambda: defaultdict(int))
    for licence, begin, end in data:
        if begin is not None and (end is None or end > begin):
            moves[licence][begin] += 1
            if end is not None:
                moves[licence][end] -= 1
    found = []
    for licence, changes in moves.items():
        seats, best = 0, None
        for at in sorted(changes):
            seats += changes[at]
            if best is None or seats > best[0]:
                best = seats, at
        found.append((licence, *best))
    return sorted(found, key=repr)


def allocations(spark, data):
    return spark.createDataFrame(data, "licence int, begin timestamp, end timestamp")


def test_peak_seats_with_a_hot_licence(spark):
    pick = random.Random(4)
    data = []
    for n in range(3000):
        begin = T0 + timedelta(minutes=pick.randint(0, 2000))
        end = None if pick.random() < 0.1 else begin + timedelta(minutes=pick.randint(-5, 300))
        data.append((7 if n % 3 == 0 else pick.randint(0, 40), None if n % 50 == 0 else begin, end))
    found = business.peak_seats(allocations(spark, data).repartition(4), "licence", "begin", "end")
    assert rows(found) == sweep(data)
    assert business.peak_seats(allocations(spark, []), "licence", "begin", "end").count() == 0


def test_a_huge_licence_is_swept_in_pieces(spark, conf):
    conf(spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false")
    data = [(1, T0 + timedelta(seconds=n), T0 + timedelta(seconds=n + 500)) for n in range(6000)] + [(k, T0, None) for k in range(2, 200)]
    moves = allocations(spark, data)
    pieces = moves.repartitionByRange("licence", "begin").withColumn("piece", F.spark_partition_id())
    hot = pieces.filter("licence = 1").groupBy("piece").count().collect()
    assert len(hot) > 8 and max(r["count"] for r in hot) < 2000
    assert rows(business.peak_seats(moves, "licence", "begin", "end").filter("licence = 1")) == [(1, 500, T0 + timedelta(seconds=499))]


SUBSCRIPTIONS = [
    (date(2024, 1, 10), None), (date(2024, 1, 20), date(2024, 1, 25)), (date(2024, 1, 5), date(2024, 3, 1)),
    (date(2024, 2, 1), date(2024, 6, 1)), (date(2024, 2, 2), date(2024, 2, 1)), (date(2024, 9, 1), None),
]


def test_retention_by_cohort(spark):
    frame = spark.createDataFrame(SUBSCRIPTIONS, "start_date date, end_date date")
    found = metrics.retention_by_cohort(frame, F.lit(date(2024, 4, 15)))
    assert rows(found, "cohort", "age", "size", "retained") == [
        (date(2024, 1, 1), 0, 3, 3), (date(2024, 1, 1), 1, 3, 2), (date(2024, 1, 1), 2, 3, 2), (date(2024, 1, 1), 3, 3, 1),
        (date(2024, 2, 1), 0, 2, 2), (date(2024, 2, 1), 1, 2, 2), (date(2024, 2, 1), 2, 2, 2),
    ]


def test_survival_counts_open_subscriptions_as_censored(spark):
    day = date(2024, 1, 1)
    data = [(day, day + timedelta(days=n)) for n in (2, 2, 5)] + [(day, None), (day + timedelta(days=7), None), (day, day + timedelta(days=50))]
    frame = spark.createDataFrame(data, "start_date date, end_date date")
    found = metrics.survival_curve(frame, F.lit(day + timedelta(days=10))).orderBy("age").collect()
    assert [(r.age, r.at_risk, r.ended) for r in found] == [(2, 6, 2), (5, 3, 1)]
    assert [round(r.survival, 9) for r in found] == [round(4 / 6, 9), round(4 / 6 * 2 / 3, 9)]
    whole = metrics.survival_curve(frame.filter("end_date is not null and end_date < '2024-02-01'"), F.lit(day + timedelta(days=40)))
    assert rows(whole.orderBy("age"), "survival")[-1][0] >= 0 and whole.agg(F.min("survival")).first()[0] == 0


def test_classification_quality(spark):
    pick = random.Random(2)
    data = [(pick.random() < 0.4, round(pick.random(), 2)) for _ in range(400)]
    frame = spark.createDataFrame([(int(y), s) for y, s in data], "label int, churn_score double")
    told = models.classification_quality(frame, "label").first()
    pairs = [(p > n) + (p == n) / 2 for y, p in data if y for z, n in data if not z]
    assert told.auc == pytest.approx(sum(pairs) / len(pairs))
    tp, fp = (sum(y == want and s >= 0.5 for y, s in data) for want in (True, False))
    fn = sum(y and s < 0.5 for y, s in data)
    assert (told.tp, told.fp, told.fn) == (tp, fp, fn) and told.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    one_sided = models.classification_quality(frame.filter("label = 1"), "label").first()
    assert one_sided.auc is None and one_sided.tn == 0


def test_held_out_customers_are_a_fixed_fifth(spark):
    frame = spark.range(5000).withColumn("out", models.held_out("id"))
    assert 850 < frame.filter("out").count() < 1150
    assert rows(frame) == rows(frame.repartition(7))


def events(spark, n, seed):
    pick = random.Random(seed)
    data = [(T0 + timedelta(hours=k % 240), pick.randint(0, n // 3), None if k % 17 == 0 else float(k % 1000), pick.choice("aab")) for k in range(n)]
    return spark.createDataFrame(data, "ts timestamp, user int, value double, kind string").withColumn("day", F.to_date("ts"))


def test_merging_days_is_one_pass(spark):
    frame = events(spark, 20_000, 5)
    args = dict(distinct=["user"], numbers=["value"], frequent=["kind"])
    days = sketches.daily_sketches(frame, "day", **args)
    assert days.count() == 10
    told = sketches.estimates(sketches.merged_sketches(days), {"low": 0.1, "median": 0.5}).first()
    once = sketches.estimates(sketches.daily_sketches(frame.withColumn("day", F.lit(1)), "day", **args).drop("day"), {"low": 0.1, "median": 0.5}).first()
    exact = frame.select("user").distinct().count()
    assert told.n == once.n == 20_000
    assert abs(told.user_distinct - once.user_distinct) <= 0.02 * exact
    assert abs(told.user_distinct - exact) <= 3 * sketches.HLL_ERROR * exact
    values = sorted(r.value for r in frame.filter("value is not null").collect())
    for quantile, value in ((0.1, told.value_low), (0.5, told.value_median)):
        rank = sum(v <= value for v in values) / len(values)
        assert abs(rank - quantile) <= 2 * sketches.KLL_ERROR
    top = told.kind_frequent
    assert [t["item"] for t in top] == ["a", "b"] and sum(t["count"] for t in top) == 20_000
    assert [(t["item"], t["count"]) for t in top] == [(t["item"], t["count"]) for t in once.kind_frequent]


def test_a_range_without_days(spark):
    days = sketches.daily_sketches(events(spark, 100, 1), "day", ["user"])
    told = sketches.estimates(sketches.merged_sketches(days.filter("day is null"))).first()
    assert told.user_distinct == 0 and told.n is None


def test_segments_are_evaluated_over_features_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(n):
        made.add(1)
        return float(n % 10)

    customers = spark.range(300).select("id", counted("id").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    found = models.evaluate_segments(customers, "id", ["a", "b"], [2, 3])
    assert {r["segments"] for r in found.collect()} == {2, 3}
    assert made.value == 300, "each count of segments reads what was written once"
