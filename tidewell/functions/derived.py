"""Descriptive columns per entity, for ``df.withColumns(...)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.dates import date_parts, tenure
from tidewell.functions.subscription import tier_rank
from tidewell.functions.text import squeezed

EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s.]+$"


def user_columns(as_of: Column) -> dict[str, Column]:
    age = F.col("age")
    return {
        "created_year": F.year("created_at"),
        "created_month": F.month("created_at"),
        **tenure("created_at", as_of, "user"),
        "age_group": F.when(age < 25, "18-24").when(age < 35, "25-34").when(age < 45, "35-44")
        .when(age < 55, "45-54").when(age < 65, "55-64").when(age >= 65, "65+"),
        "is_valid_email": F.coalesce(F.col("email").rlike(EMAIL_SHAPE), F.lit(False)),
    }


def subscription_columns(as_of: Column) -> dict[str, Column]:
    status = F.col("status")
    return {
        **date_parts("start_date", "start"),
        **tenure("start_date", as_of, "subscription"),
        "end_month": F.month("end_date"),
        "is_active": status == "active",
        "is_trial": status == "trial",
        "is_cancelled": status == "cancelled",
        "is_paid": F.col("current_mrr") > 0,
    }


def payment_columns() -> dict[str, Column]:
    status = F.col("payment_status")
    return {
        **date_parts("payment_date", "payment"),
        "is_successful": status == "success",
        "is_failed": status == "failed",
        "is_refunded": status == "refunded",
    }


def licence_columns(as_of: Column) -> dict[str, Column]:
    seats = F.col("max_seats")
    return {
        **date_parts("issued_date", "issued"),
        "seat_tier": F.when(seats <= 25, "small").when(seats <= 100, "medium").otherwise("large"),
        "license_active_flag": F.col("expiry_date") > as_of,
        "days_to_expiry": F.datediff(F.col("expiry_date"), as_of),
        "expiry_month": F.trunc("expiry_date", "month"),
    }


def allocation_columns() -> dict[str, Column]:
    active = F.col("status") == "active"
    return {
        **date_parts("allocation_date", "allocation"),
        "is_active": active,
        "event_type": F.when(active, "assigned").otherwise("released"),
        "seat_change": F.when(active, 1).otherwise(-1),
    }


def plan_columns() -> dict[str, Column]:
    price = F.col("price")
    yearly = F.col("billing_cycle") == "annual"
    return {
        **date_parts("created_at", "created"),
        "monthly_price_equivalent": F.round(F.when(yearly, price / 12).otherwise(price), 2),
        "is_paid": price > 0,
        "tier_rank": tier_rank("tier"),
        "billings_per_year": F.when(yearly, 1).otherwise(12),
    }


def ticket_columns() -> dict[str, Column]:
    return {
        **date_parts("created_at", "created"),
        "description_clean": squeezed("description"),
        "description_length": F.length(squeezed("description")),
    }


# Event types of the product.
EVENT_TYPES = ["login", "content_view", "feature_used", "session_end"]


def event_columns() -> dict[str, Column]:
    kind = F.col("event_type")
    return {
        "event_date": F.to_date(F.col("event_timestamp").try_cast("timestamp")),
        **{f"is_{name}": kind == name for name in EVENT_TYPES},
        "is_known_event_type": F.coalesce(kind.isin(EVENT_TYPES), F.lit(False)),
    }


# Product categories.
PRODUCT_CATEGORIES = ["Streaming", "E-Learning", "Cloud Tools", "Creative Suite", "Productivity"]

BUSINESS_LINES = {
    "Streaming": "consumer",
    "E-Learning": "consumer",
    "Cloud Tools": "business",
    "Creative Suite": "business",
    "Productivity": "business",
}


def product_columns() -> dict[str, Column]:
    category = F.col("category")
    lines = F.create_map(*[F.lit(x) for pair in BUSINESS_LINES.items() for x in pair])
    return {
        "product_family": F.split("product_name", " ")[0],
        "business_line": F.coalesce(lines[category], F.lit("other")),
        "is_known_category": F.coalesce(category.isin(PRODUCT_CATEGORIES), F.lit(False)),
    }
