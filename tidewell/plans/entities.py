"""The ten curated entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.derived import EMAIL_SHAPE, EVENT_TYPES, PRODUCT_CATEGORIES
from tidewell.functions.subscription import (
    TIERS,
    USD_RATES,
    canonical_tier,
    convert_from_usd,
    convert_to_usd,
    exchange_rate,
    has_churned,
)
from tidewell.functions.text import MEANINGLESS, domain_or_other, lowered, titled, trimmed, uppered
from tidewell.operators.nested import flatten_structs, parse_json
from tidewell.operators.quality import (
    Rule,
    all_required,
    not_negative,
    one_of,
    ordered,
    required,
    within,
)
from tidewell.operators.references import Reference
from tidewell.plans.entity import EntityPlan
from tidewell.plans.steps import Check, Derive, Drop, Latest, References, Reshape, Typed
from tidewell.sources.lineage import TECHNICAL

# The business domains.
COUNTRIES = [
    "Australia", "Brazil", "Canada", "China", "Denmark", "France", "Germany", "India",
    "Indonesia", "Italy", "Japan", "Netherlands", "Norway", "Philippines", "Singapore",
    "South Korea", "Spain", "Sweden", "Thailand", "United Kingdom", "United States", "Vietnam",
]
GENDERS = ["female", "male", "other"]
CHANNELS = ["organic", "paid", "referral"]
BILLING_CYCLES = ["monthly", "annual"]
CURRENCIES = list(USD_RATES)
SUBSCRIPTION_STATUSES = ["active", "cancelled", "expired", "trial"]
CHANGE_TYPES = ["upgrade", "initial", "downgrade"]
PAYMENT_STATUSES = ["refunded", "success", "failed"]
PAYMENT_METHODS = [
    "google_pay", "paypal", "apple_pay", "credit_card", "bank_transfer", "invoice",
]
SEAT_STATUSES = ["active", "deactivated"]
TICKET_CATEGORIES = ["billing", "technical", "cancellation", "feature_request"]

# Optional: short country codes some sources deliver, off unless asked for.
COUNTRY_ALIASES = {"Us": "United States", "Uk": "United Kingdom"}

# The fields of an event document.
PAYLOAD_SCHEMA = (
    "content_id bigint, created_at string, device_type string, event_id string, "
    "event_properties struct<duration_sec: bigint, referrer: string>, event_timestamp string, "
    "event_type string, feature_name string, platform string, session_id string, "
    "subscription_id bigint, user_id bigint"
)

PRODUCTS = EntityPlan(
    name="products",
    columns=["product_id", "product_name", "category", "created_at", "ingest_time"],
    steps=[
        Drop(TECHNICAL),
        Typed({"created_at": "timestamp", "ingest_time": "timestamp"}, rest=True),
        Latest(["product_id", "created_at"], message="duplicate product_id"),
        Typed({"product_id": "int", "product_name": "string", "category": "string"}, rest=True),
        Check(all_required(["product_id", "product_name", "category", "ingest_time"])),
        Derive(lambda _: {"product_name": trimmed("product_name")}),
    ],
    merge_keys=["product_id"],
    newest=["ingest_time", "created_at"],
    extra_columns=True,
)


def users_plan(country_aliases: dict[str, str] | None = None) -> EntityPlan:
    def countries(_):
        country = F.col("country")
        for alias, name in (country_aliases or {}).items():
            country = F.when(F.col("country") == alias, F.lit(name)).otherwise(country)
        return {
            "is_valid_country": country.isin(COUNTRIES),
            "country": domain_or_other(country, COUNTRIES),
        }

    return EntityPlan(
        name="users",
        columns=[
            "user_id", "first_name", "last_name", "email", "country", "age", "gender",
            "acquisition_channel", "is_enterprise", "created_at", "ingest_time",
            "is_valid_country",
        ],
        steps=[
            Drop(TECHNICAL),
            Latest(["user_id", "created_at"], message="duplicate user_id"),
            Typed(
                {
                    "user_id": "bigint",
                    "first_name": "string",
                    "last_name": "string",
                    "email": "string",
                    "country": "string",
                    "age": "int",
                    "gender": "string",
                    "acquisition_channel": "string",
                    "is_enterprise": "boolean",
                    "created_at": "timestamp",
                    "ingest_time": "timestamp",
                },
                rest=True,
            ),
            Derive(
                lambda _: {
                    "first_name": trimmed("first_name"),
                    "last_name": trimmed("last_name"),
                    "email": lowered("email"),
                    "country": titled("country"),
                    "gender": lowered("gender"),
                    "acquisition_channel": lowered("acquisition_channel"),
                }
            ),
            Check(all_required(["user_id", "created_at"])),
            Derive(countries),
            Check([within("age", 18, 100)]),
            Check([one_of("gender", GENDERS)]),
            Check([one_of("acquisition_channel", CHANNELS)]),
            Check([required("is_enterprise", "invalid is_enterprise")]),
        ],
        merge_keys=["user_id"],
        newest=["created_at", "ingest_time"],
        extra_columns=True,
    )


USERS = users_plan()

PLANS = EntityPlan(
    name="plans",
    columns=[
        "product_id", "id", "plan_id", "tier", "billing_cycle", "price", "currency",
        "created_at", "ingest_time", "source_identifier", "batch_id",
    ],
    steps=[
        Typed(
            {
                "id": "bigint",
                "plan_id": "int",
                "product_id": "int",
                "tier": "string",
                "billing_cycle": "string",
                "price": "decimal(18,2)",
                "currency": "string",
                "created_at": "timestamp",
                "ingest_time": "timestamp",
                "source_identifier": "string",
                "batch_id": "string",
            }
        ),
        Derive(
            lambda _: {
                "tier": canonical_tier("tier"),
                "billing_cycle": lowered("billing_cycle"),
                "currency": uppered("currency"),
            }
        ),
        Check(
            [
                *all_required(["plan_id", "product_id"]),
                one_of("tier", TIERS),
                one_of("billing_cycle", BILLING_CYCLES),
                one_of("currency", CURRENCIES),
                not_negative("price"),
                required("created_at"),
            ]
        ),
        Latest(["plan_id", "created_at"], message="duplicate plan_id"),
        References(
            [
                Reference(
                    "products",
                    {"product_id": "product_id"},
                    "product_id not found in silver products",
                )
            ]
        ),
    ],
    merge_keys=["plan_id"],
    newest=["created_at", "ingest_time"],
    newer_than=None,
)

MRR_RULE = Rule(
    "mrr_matches_status",
    "(status = 'trial' and current_mrr = 0) or (status <> 'trial' and current_mrr > 0)",
    "current_mrr does not fit status",
)

SUBSCRIPTIONS = EntityPlan(
    name="subscriptions",
    columns=[
        "user_id", "subscription_id", "plan_id", "start_date", "end_date", "status",
        "current_mrr", "created_at", "ingest_time", "churn",
    ],
    steps=[
        Drop(TECHNICAL),
        Latest(["subscription_id", "created_at"], message="duplicate subscription_id"),
        Typed(
            {
                "subscription_id": "bigint",
                "user_id": "bigint",
                "plan_id": "bigint",
                "start_date": "date",
                "end_date": "date",
                "status": "string",
                "current_mrr": "decimal(10,2)",
                "created_at": "timestamp",
                "ingest_time": "timestamp",
            }
        ),
        Check(all_required(["subscription_id", "user_id", "plan_id", "start_date", "status"])),
        Derive(lambda _: {"status": lowered("status")}),
        Check([one_of("status", SUBSCRIPTION_STATUSES)]),
        References(
            [Reference("users", {"user_id": "user_id"}, "user_id not found in silver users")]
        ),
        Check([ordered("start_date", "end_date", open_end=True)]),
        Check([MRR_RULE]),
        Derive(lambda context: {"churn": has_churned("status", "end_date", context.today())}),
    ],
    merge_keys=["subscription_id"],
    newest=["created_at", "ingest_time"],
)

SUBSCRIPTION_CHANGES = EntityPlan(
    name="subscription_changes",
    columns=[
        "new_plan_id", "old_plan_id", "change_id", "subscription_id", "change_date",
        "ingest_time", "change_type",
    ],
    steps=[
        Latest(["change_id", "change_date"], message="duplicate change_id"),
        Typed(
            {
                "change_id": "bigint",
                "subscription_id": "bigint",
                "old_plan_id": "int",
                "new_plan_id": "int",
                "change_type": "string",
                "change_date": "timestamp",
                "ingest_time": "timestamp",
            }
        ),
        Check(
            all_required(
                [
                    "change_id", "subscription_id", "old_plan_id", "new_plan_id", "change_type",
                    "change_date", "ingest_time",
                ]
            )
        ),
        Derive(lambda _: {"change_type": lowered("change_type")}),
        Check([one_of("change_type", CHANGE_TYPES)]),
        References(
            [
                Reference("plans", {role: "plan_id"}, f"{role} not found in silver plans")
                for role in ("old_plan_id", "new_plan_id")
            ]
        ),
    ],
    merge_keys=["change_id", "change_date"],
    batch_key=["change_id"],
    newest=["change_date", "ingest_time"],
)

PAYMENTS = EntityPlan(
    name="payments",
    columns=[
        "subscription_id", "payment_id", "amount", "currency", "payment_status", "payment_date",
        "payment_method", "ingest_time", "exchange_rate", "amount_in_currency", "amount_usd",
    ],
    steps=[
        Drop(TECHNICAL),
        Typed({"payment_date": "timestamp", "ingest_time": "timestamp"}, rest=True),
        Latest(["payment_id", "payment_date"], message="duplicate payment_id"),
        Typed(
            {
                "payment_id": "bigint",
                "subscription_id": "bigint",
                "amount": "decimal(10,2)",
                "currency": "string",
                "payment_status": "string",
                "payment_date": "timestamp",
                "payment_method": "string",
                "ingest_time": "timestamp",
            }
        ),
        Derive(
            lambda _: {
                "payment_status": lowered("payment_status"),
                "currency": uppered("currency"),
                "payment_method": lowered("payment_method"),
            }
        ),
        Check(
            [
                required("payment_id"),
                one_of("payment_status", PAYMENT_STATUSES, "Invalid payment_status"),
                one_of("currency", CURRENCIES, "Invalid currency"),
                one_of("payment_method", PAYMENT_METHODS, "Invalid payment_method"),
            ]
        ),
        References(
            [
                Reference(
                    "subscriptions",
                    {"subscription_id": "subscription_id"},
                    "subscription_id not found in silver subscriptions",
                )
            ]
        ),
        Derive(
            lambda _: {
                "exchange_rate": exchange_rate("currency"),
                "amount_in_currency": convert_from_usd("amount", exchange_rate("currency")),
                "amount_usd": convert_to_usd("amount", exchange_rate("currency")),
            }
        ),
    ],
    merge_keys=["payment_id", "payment_date"],
    batch_key=["payment_id"],
    newest=["payment_date", "ingest_time"],
)

LICENSE_KEYS = EntityPlan(
    name="license_keys",
    columns=[
        "license_id", "subscription_id", "max_seats", "issued_date", "expiry_date", "ingest_time",
    ],
    steps=[
        Latest(["license_id", "issued_date"], message="duplicate license_id"),
        Typed(
            {
                "license_id": "bigint",
                "subscription_id": "bigint",
                "max_seats": "int",
                "issued_date": "date",
                "expiry_date": "date",
                "ingest_time": "timestamp",
            }
        ),
        Check(all_required(["license_id", "subscription_id", "issued_date", "expiry_date"])),
        References(
            [
                Reference(
                    "subscriptions",
                    {"subscription_id": "subscription_id"},
                    "subscription_id not found in silver_subscriptions",
                )
            ]
        ),
        Check([within("max_seats", 5, 500)]),
        Check([ordered("issued_date", "expiry_date", strict=True)]),
    ],
    merge_keys=["license_id"],
    newest=["ingest_time", "issued_date"],
)

LICENSE_ALLOCATIONS = EntityPlan(
    name="license_allocations",
    columns=["license_id", "allocation_id", "seat_number", "status", "allocation_date", "ingest_time"],
    steps=[
        Typed(
            {
                "allocation_id": "bigint",
                "license_id": "bigint",
                "seat_number": "int",
                "status": "string",
                "allocation_date": "timestamp",
                "ingest_time": "timestamp",
            }
        ),
        Derive(lambda _: {"status": lowered("status")}),
        Check([required("allocation_id"), one_of("status", SEAT_STATUSES)]),
        Latest(["allocation_id", "allocation_date"], message="duplicate allocation_id"),
        References(
            [
                Reference(
                    "license_keys",
                    {"license_id": "license_id"},
                    "license_id not found in silver licenses",
                )
            ],
            rules=[within("seat_number", 1, 550)],
        ),
    ],
    merge_keys=["allocation_id"],
    newest=["ingest_time", "allocation_date"],
    newer_than=None,
)

SUPPORT_TICKETS = EntityPlan(
    name="support_tickets",
    columns=["user_id", "ticket_id", "category", "description", "created_at", "ingest_time"],
    steps=[
        Typed(
            {
                "ticket_id": "bigint",
                "user_id": "bigint",
                "category": "string",
                "description": "string",
                "created_at": "timestamp",
                "ingest_time": "timestamp",
            }
        ),
        Derive(lambda _: {"category": lowered("category")}),
        Check(
            [
                *all_required(["ticket_id", "user_id", "created_at"]),
                one_of("category", TICKET_CATEGORIES),
            ]
        ),
        Latest(["ticket_id", "created_at"], message="duplicate ticket_id"),
        References(
            [Reference("users", {"user_id": "user_id"}, "user_id not found in silver users")]
        ),
    ],
    merge_keys=["ticket_id"],
    newest=["created_at", "ingest_time"],
    newer_than=None,
)


def usage_events_plan(payload_schema: str = PAYLOAD_SCHEMA) -> EntityPlan:
    """The payload schema may be one found by ``infer_json_schema``; fields it
    does not know are null and further ones are kept."""

    typed = {
        "created_at_event": "timestamp",
        "processed": "boolean",
        "ingest_time": "timestamp",
        "content_id": "bigint",
        "created_at": "string",
        "device_type": "string",
        "event_id": "string",
        "event_properties_duration_sec": "bigint",
        "event_properties_referrer": "string",
        "event_timestamp": "string",
        "event_type": "string",
        "feature_name": "string",
        "platform": "string",
        "session_id": "string",
        "subscription_id": "bigint",
        "user_id": "bigint",
    }

    def unpacked(df: DataFrame) -> DataFrame:
        outer = df.withColumnRenamed("created_at", "created_at_event")
        flat = flatten_structs(parse_json(outer, "data", payload_schema)).drop("id")
        absent = {c: F.lit(None).cast(t) for c, t in typed.items() if c not in flat.columns}
        return flat.withColumns(absent)

    first = ["subscription_id", "user_id", "created_at_event", "processed", "ingest_time"]
    return EntityPlan(
        name="usage_events",
        columns=[*first, *[c for c in typed if c not in first], "event_at"],
        steps=[
            Reshape(unpacked),
            Typed(typed, rest=True),
            Derive(lambda _: {"event_at": F.col("event_timestamp").try_cast("timestamp")}),
            Check([required("event_id")]),
            Latest(["event_id", "event_timestamp"], message="duplicate event_id"),
            References(
                [
                    Reference("users", {"user_id": "user_id"}, "user_id not found in silver users"),
                    Reference(
                        "subscriptions",
                        {"subscription_id": "subscription_id"},
                        "subscription_id not found in silver subscriptions",
                        optional=True,
                    ),
                ]
            ),
        ],
        merge_keys=["event_id"],
        newest=["ingest_time", "event_timestamp"],
        newer_than=None,
        extra_columns=True,
    )


USAGE_EVENTS = usage_events_plan()

# In the order in which each finds its references curated.
ENTITIES = {
    plan.name: plan
    for plan in (
        PRODUCTS, USERS, PLANS, SUBSCRIPTIONS, SUBSCRIPTION_CHANGES, PAYMENTS, LICENSE_KEYS,
        LICENSE_ALLOCATIONS, SUPPORT_TICKETS, USAGE_EVENTS,
    )
}

# Checks that are documented for the entities but not part of them: off unless
# asked for with ``strict``.
_EMAIL = Rule("email_shape", f"email rlike '{EMAIL_SHAPE}'".replace("\\", "\\\\"), "invalid email")
_WORDS = Rule(
    "description_meaning",
    "lower(trim(description)) not in (" + ", ".join(f"'{text}'" for text in MEANINGLESS) + ")",
    "meaningless description",
)
OPTIONAL = {
    "products": [Check([one_of("category", PRODUCT_CATEGORIES)])],
    "users": [Check([_EMAIL])],
    "subscriptions": [
        References([Reference("plans", {"plan_id": "plan_id"}, "plan_id not found in silver plans")])
    ],
    "subscription_changes": [
        References(
            [
                Reference(
                    "subscriptions",
                    {"subscription_id": "subscription_id"},
                    "subscription_id not found in silver subscriptions",
                )
            ]
        )
    ],
    "support_tickets": [Check([_WORDS])],
    "usage_events": [Check([one_of("event_type", EVENT_TYPES)])],
}


def strict(name: str) -> EntityPlan:
    """An entity with its optional checks."""
    return ENTITIES[name].also(*OPTIONAL.get(name, ()))
