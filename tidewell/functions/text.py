"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    return F.trim(name)


def lowered(name: str) -> Column:
    return F.lower(F.trim(name))


def uppered(name: str) -> Column:
    return F.upper(F.trim(name))


def titled(name: str) -> Column:
    return F.initcap(F.trim(name))


def snaked(name: str) -> Column:
    """Lower case with every run of white space turned into one underscore."""
    return F.lower(F.regexp_replace(F.trim(name), r"\s+", "_"))


def squeezed(name: str) -> Column:
    """Runs of white space become one space."""
    return F.trim(F.regexp_replace(F.col(name), r"\s+", " "))


def domain_or_other(column: Column, domain: list[str], other: str = "Other") -> Column:
    return F.when(column.isin(domain), column).otherwise(F.lit(other))


# Descriptions that say nothing.
MEANINGLESS = ["", "n/a", "na", "none", "null", "test", "no description"]


def is_meaningless(name: str) -> Column:
    return F.coalesce(lowered(name), F.lit("")).isin(MEANINGLESS)


# Ticket categories and the words that select them, first match wins.
TICKET_WORDS = {
    "technical": ["technical", "bug", "error", "account", "network"],
    "billing": ["billing", "payment", "refund"],
    "cancellation": ["cancel"],
}
TICKET_DEFAULT = "feature_request"


def ticket_category(name: str) -> Column:
    """Category of a free text by the words it contains."""
    low = F.lower(F.col(name))
    result = F.lit(TICKET_DEFAULT)
    for category, words in reversed(TICKET_WORDS.items()):
        result = F.when(low.rlike("|".join(words)), F.lit(category)).otherwise(result)
    return result
