"""Expressions of the subscription business."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One US dollar in each currency.
USD_RATES = {"USD": "1.0", "EUR": "0.93", "GBP": "0.80", "VND": "25500.0"}

# Spellings of the plan tiers.
TIER_NAMES = {
    "free": "Free Trial",
    "free_trial": "Free Trial",
    "trial": "Free Trial",
    "basic": "Basic",
    "standard": "Standard",
    "premium": "Premium",
    "enterprise": "Enterprise",
}
TIERS = ["Free Trial", "Basic", "Standard", "Premium", "Enterprise"]

# Statuses that mean the customer has left.
ENDED_STATUSES = ["cancelled", "canceled", "expired"]


def _literal_map(entries: dict[str, Column]) -> Column:
    return F.create_map(*[part for key, value in entries.items() for part in (F.lit(key), value)])


def canonical_tier(name: str) -> Column:
    """Known spellings become the tier name; anything else is left as it is."""
    from tidewell.functions.text import snaked

    names = _literal_map({k: F.lit(v) for k, v in TIER_NAMES.items()})
    return F.coalesce(names[snaked(name)], F.col(name))


def tier_rank(name: str) -> Column:
    return _literal_map({tier: F.lit(n) for n, tier in enumerate(TIERS)})[F.col(name)]


def exchange_rate(currency: str) -> Column:
    """Units of the currency per US dollar; null for an unknown currency."""
    rates = _literal_map({k: F.lit(v).cast("decimal(18,6)") for k, v in USD_RATES.items()})
    return rates[F.upper(F.trim(currency))]


def convert_from_usd(amount: str, rate: Column) -> Column:
    return (F.col(amount).cast("decimal(18,2)") * rate).cast("decimal(18,2)")


def convert_to_usd(amount: str, rate: Column) -> Column:
    return (F.col(amount).cast("decimal(18,2)") / rate).cast("decimal(18,2)")


def has_churned(status: str, end_date: str, as_of: Column) -> Column:
    left = F.lower(F.col(status)).isin(ENDED_STATUSES) | (F.to_date(end_date) <= as_of)
    return F.when(left, F.lit("Yes")).otherwise(F.lit("No"))


def monthly_price(price: Column, cycle: Column, is_free: Column) -> Column:
    """What a plan brings in per month, whatever its billing cycle."""
    per_month = F.when(F.lower(cycle) == "monthly", price).otherwise(price / 12)
    return F.round(F.when(is_free, F.lit(0)).otherwise(per_month), 2)


def charge_amount(price: Column, cycle: Column) -> Column:
    """The amount charged at once where the listed price is a monthly one."""
    return F.round(F.when(F.lower(cycle) == "annual", price * 12).otherwise(price), 2)
