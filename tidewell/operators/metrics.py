"""Recurring-revenue metrics.

Everything is a grouped aggregate or a join of frames already reduced to one
row per user and month, so no key's detail rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recurring_revenue(subscriptions: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """MRR and ARR of the active subscriptions."""
    active = subscriptions.filter(F.col("status") == "active")
    mrr = F.sum("current_mrr")
    return active.groupBy(*by).agg(
        mrr.alias("mrr"), (mrr * 12).alias("arr"), F.count("*").alias("active_subscriptions")
    )


def revenue(payments: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Successful payments and the subscribers behind them."""
    paid = payments.filter(F.col("payment_status") == "success")
    return paid.groupBy(*by).agg(
        F.sum("amount").alias("revenue"),
        F.countDistinct("subscription_id").alias("subscribers"),
    )


def churn_by_month(subscriptions: DataFrame) -> DataFrame:
    """Per month: subscriptions running when it began, those of them that ended
    in it, churn and retention rate.

    Starts and ends are counted per month first; the running totals then go
    over one row per month, from the first month to the last, quiet ones too.
    """
    started = subscriptions.filter(F.col("start_date").isNotNull())
    moves = started.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.trunc("start_date", "month").alias("month"), F.lit(1).alias("s"), F.lit(0).alias("e")),
                    F.when(
                        F.col("end_date").isNotNull(),
                        F.struct(
                            F.trunc("end_date", "month").alias("month"),
                            F.lit(0).alias("s"),
                            F.lit(1).alias("e"),
                        ),
                    ),
                )
            )
        ).alias("m"),
        (F.trunc("start_date", "month") < F.trunc("end_date", "month")).alias("ran_before"),
    )
    ended_here = F.when((F.col("m.e") == 1) & F.col("ran_before"), 1).otherwise(0)
    monthly = moves.groupBy(F.col("m.month").alias("month")).agg(
        F.sum("m.s").alias("starts"), F.sum("m.e").alias("ends"), F.sum(ended_here).alias("churned")
    )
    return _with_rates(_running_at_start(_every_month(monthly)))


def _every_month(monthly: DataFrame) -> DataFrame:
    """The months between the first and the last that have no row, with zeros."""
    counts = ["starts", "ends", "churned"]
    span = monthly.agg(F.min("month").alias("__from"), F.max("month").alias("__to"))
    spine = span.filter(F.col("__from").isNotNull()).select(
        F.explode(F.sequence("__from", "__to", F.expr("interval 1 month"))).alias("month"),
        *[F.lit(0).alias(c) for c in counts],
    )
    both = monthly.unionByName(spine)
    return both.groupBy("month").agg(*[F.sum(c).alias(c) for c in counts])


def _running_at_start(monthly: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    # One row per calendar month: bounded by the years the business runs.
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    running = F.sum(F.col("starts") - F.col("ends")).over(before)
    return monthly.withColumn("active_at_start", F.coalesce(running, F.lit(0)))


def _with_rates(monthly: DataFrame) -> DataFrame:
    churn = F.when(F.col("active_at_start") > 0, F.col("churned") / F.col("active_at_start"))
    return monthly.select(
        "month",
        "active_at_start",
        "churned",
        churn.alias("churn_rate"),
        (F.lit(1.0) - churn).alias("retention_rate"),
    )


def lifetime_value(subscriptions: DataFrame, churn_rate: float | Column) -> DataFrame:
    """Average revenue per active user over the churn rate."""
    rate = F.lit(churn_rate) if isinstance(churn_rate, (int, float)) else churn_rate
    active = subscriptions.filter(F.col("status") == "active")
    arpu = F.sum("current_mrr").cast("double") / F.countDistinct("user_id")
    return active.agg(arpu.alias("arpu")).withColumn(
        "ltv", F.when(rate > 0, F.col("arpu") / rate)
    )


def monthly_user_revenue(payments: DataFrame, user: str, amount: str, stamp: str) -> DataFrame:
    return payments.groupBy(
        F.col(user).alias("user_id"), F.trunc(stamp, "month").alias("month")
    ).agg(F.sum(amount).alias("mrr"))


def net_retention(user_revenue: DataFrame) -> DataFrame:
    """Per month: revenue now of the users who paid in the month before, over
    what they paid then."""
    # each month counts as itself and as the month before the next one
    amount = user_revenue.schema["mrr"].dataType
    none, mrr = F.lit(None).cast(amount), F.col("mrr")
    own = F.struct("month", mrr.alias("now"), none.alias("then"), F.lit(1).alias("pays"), F.lit(0).alias("paid"))
    later = F.struct(F.add_months("month", 1).alias("month"), none.alias("now"), mrr.alias("then"), F.lit(0).alias("pays"), F.lit(1).alias("paid"))
    sides = user_revenue.select("user_id", F.explode(F.array(own, later)).alias("m")).select("user_id", "m.*")
    by_user = sides.groupBy("user_id", "month").agg(*[F.max(c).alias(c) for c in ("now", "then", "pays", "paid")])
    cohort = by_user.filter(F.col("paid") == 1)
    # revenue without a user is of no user that could stay
    stays = F.col("user_id").isNotNull() & (F.col("pays") == 1)
    return (
        cohort.groupBy("month")
        .agg(
            F.sum("then").alias("starting_mrr"),
            F.coalesce(F.sum(F.when(stays, F.col("now"))), F.lit(0)).alias("retained_mrr"),
            F.count("*").alias("cohort_users"),
            F.count(F.when(stays, 1)).alias("retained_users"),
        )
        .withColumn("nrr", F.col("retained_mrr").cast("double") / F.col("starting_mrr").cast("double"))
    )


def revenue_trend(monthly: DataFrame, value: str = "revenue", month: str = "month") -> DataFrame:
    """Least-squares line through the monthly revenue and its next value."""
    x = (F.year(month) * 12 + F.month(month)).cast("double")
    y = F.col(value).cast("double")
    fitted = monthly.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.max(x).alias("__last"),
        F.count("*").alias("months"),
    )
    return fitted.withColumn(
        "next_value", F.col("intercept") + F.col("slope") * (F.col("__last") + 1)
    ).drop("__last")


def _age(start: Column, at: Column) -> Column:
    """Whole calendar months between two dates."""
    return ((F.year(at) - F.year(start)) * 12 + F.month(at) - F.month(start)).cast("int")


def retention_by_cohort(subscriptions: DataFrame, as_of: Column) -> DataFrame:
    """cohort, age, size, retained, share: subscriptions by the month of their start, and how
    many still ran ``age`` calendar months later.

    A subscription runs through the month in which it ends.  One aggregate counts the ends per
    cohort and age; the triangle is built from these few rows, up to the month of ``as_of``.
    """
    start, end = F.col("start_date"), F.col("end_date")
    lasted = F.when((end <= as_of) & (end >= start), _age(start, end))
    ended = subscriptions.filter(start <= as_of).groupBy(F.trunc(start, "month").alias("cohort"), lasted.alias("age")).agg(F.count("*").alias("n"))
    size = ended.groupBy("cohort").agg(F.sum("n").alias("size"))
    ages = size.withColumn("age", F.explode(F.sequence(F.lit(0), _age(F.col("cohort"), as_of))))
    triangle = ages.join(ended.filter(F.col("age").isNotNull()), ["cohort", "age"], "left")
    before = Window.partitionBy("cohort").orderBy("age").rowsBetween(Window.unboundedPreceding, -1)
    retained = F.col("size") - F.coalesce(F.sum("n").over(before), F.lit(0))
    return triangle.select("cohort", "age", "size", retained.alias("retained"), (retained / F.col("size")).alias("share"))


def survival_curve(subscriptions: DataFrame, as_of: Column, unit: str = "day") -> DataFrame:
    """age, at_risk, ended, survival: the product-limit estimate of a subscription's lifetime.

    Subscriptions that run on ``as_of`` are censored at their age: they count as at risk up to
    it and never as ended.  Only one row per age meets in a task.
    """
    start = F.col("start_date")
    over = F.col("end_date").isNotNull() & (F.col("end_date") <= as_of)
    last = F.when(over, F.greatest("end_date", start)).otherwise(as_of)
    age = F.date_diff(last, start) if unit == "day" else _age(start, last)
    ages = subscriptions.filter(start <= as_of).groupBy(age.alias("age")).agg(F.count("*").alias("n"), F.count_if(over).alias("ended"))
    from_here = Window.orderBy(F.desc("age"))
    at_risk = ages.withColumn("at_risk", F.sum("n").over(from_here))
    upto = Window.orderBy("age").rowsBetween(Window.unboundedPreceding, 0)
    kept = at_risk.withColumn("survival", F.product(F.lit(1.0) - F.col("ended") / F.col("at_risk")).over(upto))
    return kept.filter(F.col("ended") > 0).select("age", "at_risk", "ended", "survival")
