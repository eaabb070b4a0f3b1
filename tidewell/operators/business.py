"""Operators of the subscription business."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.references import (
    Reference,
    having_reference,
    lacking_reference,
    looked_up,
    mark_reference,
)
from tidewell.session import settle

# What points to a customer who may leave.
RISK_TICKETS = ["billing", "cancellation"]
PROBLEM_PAYMENTS = ["failed", "refunded"]


def risky_users(tickets: DataFrame) -> DataFrame:
    """Users with a ticket about billing or cancellation."""
    return tickets.filter(F.col("category").isin(RISK_TICKETS)).select("user_id").distinct()


def problem_subscriptions(payments: DataFrame) -> DataFrame:
    """Subscriptions with a failed or refunded payment."""
    hit = payments.filter(F.col("payment_status").isin(PROBLEM_PAYMENTS))
    return hit.select("subscription_id").distinct()


def mark_churn_risk(
    subscriptions: DataFrame, tickets: DataFrame, payments: DataFrame
) -> DataFrame:
    """Flag subscriptions whose user is risky or which had a problem payment."""
    by_user = Reference("", {"user_id": "user_id"}, "")
    by_payment = Reference("", {"subscription_id": "subscription_id"}, "")
    hits = tickets.filter(F.col("category").isin(RISK_TICKETS))
    fails = payments.filter(F.col("payment_status").isin(PROBLEM_PAYMENTS))
    marked = mark_reference(subscriptions, hits, by_user, "__calm_user")
    marked = mark_reference(marked, fails, by_payment, "__clean_payments")
    risk = ~(F.col("__calm_user") & F.col("__clean_payments"))
    return marked.withColumn("at_risk", risk).drop("__calm_user", "__clean_payments")


def cancelled_users(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.filter(F.col("status") == "cancelled").select("user_id").distinct()


def unlinked_cancellations(tickets: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Cancellation tickets of users who have no cancelled subscription."""
    asked = tickets.filter(F.col("category") == "cancellation")
    gone = subscriptions.filter(F.col("status") == "cancelled")
    return lacking_reference(asked, gone, {"user_id": "user_id"})


def linked_cancellations(tickets: DataFrame, subscriptions: DataFrame) -> DataFrame:
    asked = tickets.filter(F.col("category") == "cancellation")
    gone = subscriptions.filter(F.col("status") == "cancelled")
    return having_reference(asked, gone, {"user_id": "user_id"})


# Seats are unfolded block by block, so that no array grows with the licence.
SEAT_BLOCK = 1000


def expand_seats(licences: DataFrame, seats: str) -> DataFrame:
    """One row per used seat, numbered from 1."""
    count = F.col(seats)
    blocks = licences.filter(count >= 1).withColumn(
        "__from", F.explode(F.sequence(F.lit(1), count, F.lit(SEAT_BLOCK)))
    )
    last = F.least(count, F.col("__from") + F.lit(SEAT_BLOCK - 1))
    seated = blocks.withColumn("seat_number", F.explode(F.sequence(F.col("__from"), last)))
    return seated.drop("__from")


def seats_in_range(
    allocations: DataFrame, licences: DataFrame, how: str = "inner"
) -> DataFrame:
    """Allocations with a flag that the seat exists in their licence."""
    joined = looked_up(
        allocations, licences, {"license_id": "license_id"}, ["max_seats"], how
    )
    fits = F.coalesce(F.col("seat_number").between(F.lit(1), F.col("max_seats")), F.lit(False))
    return joined.withColumn("seat_exists", fits)


def seat_utilisation(licences: DataFrame, allocations: DataFrame) -> DataFrame:
    """Active seats per licence against the seats it may use."""
    active = (
        allocations.filter(F.col("status") == "active")
        .groupBy(F.col("license_id").alias("__license"))
        .agg(F.countDistinct("seat_number").alias("active_seats"))
    )
    used = F.coalesce(F.col("active_seats"), F.lit(0))
    return (
        licences.join(active, F.col("license_id") == F.col("__license"), "left")
        .drop("__license")
        .withColumn("active_seats", used)
        .withColumn("is_fully_used", used >= F.col("max_seats"))
    )


def sessions(
    events: DataFrame,
    session: Sequence[str],
    stamp: str = "event_at",
    kind: str = "event_type",
    opening: str = "login",
    closing: str = "session_end",
) -> DataFrame:
    """One row per session: its first login, its last end and what lies between."""
    at, what = F.col(stamp), F.col(kind)
    return events.groupBy(*session).agg(
        F.min(F.when(what == opening, at)).alias("opened_at"),
        F.max(F.when(what == closing, at)).alias("closed_at"),
        F.min(at).alias("first_event_at"),
        F.max(at).alias("last_event_at"),
        F.count("*").alias("event_count"),
        F.count_if(what == opening).alias("opening_count"),
        F.count_if(what == closing).alias("closing_count"),
    )


def peak_seats(allocations: DataFrame, licence: str, begin: str, end: str) -> DataFrame:
    """Per licence the most seats taken at once, and since when.

    A seat is taken from ``begin`` on and free again at ``end`` (never, where that is null);
    changes of one moment count together.  The sweep runs in pieces of the order by licence
    and moment, cut evenly by range partitioning, so a huge licence is no single task: each
    piece sums its changes, and the sums of a licence's earlier pieces are carried in.
    """
    valid = allocations.filter(F.col(begin).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(begin))))
    moves = F.array(F.struct(F.col(begin).alias("at"), F.lit(1).alias("change")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("change")))
    moves = valid.select(F.col(licence).alias("licence"), F.inline(moves)).filter(F.col("at").isNotNull())
    moves = moves.groupBy("licence", "at").agg(F.sum("change").alias("change"))
    pieces = moves.repartitionByRange("licence", "at").withColumn("piece", F.spark_partition_id())
    pieces = settle(pieces, "sweep")
    inside = Window.partitionBy("licence", "piece").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    running = pieces.withColumn("seats", F.sum("change").over(inside))
    # of each piece of a licence: what it adds, and its own highest point, the earliest of equal ones
    highest = F.max_by(F.struct("seats", "at"), F.struct("seats", (-F.unix_micros(F.col("at").cast("timestamp"))).alias("early")))
    parts = running.groupBy("licence", "piece").agg(F.sum("change").alias("added"), highest.alias("top"))
    earlier = Window.partitionBy("licence").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("seats", F.col("top.seats") + F.coalesce(F.sum("added").over(earlier), F.lit(0)))
    best = F.max_by(F.struct("seats", "top.at"), F.struct("seats", -F.col("piece")))
    peak = carried.groupBy("licence").agg(best.alias("best"))
    return peak.select(F.col("licence").alias(licence), F.col("best.seats").alias("peak"), F.col("best.at").alias("peak_at"))
