"""Date arithmetic and event-time slices."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def end_not_before(start: str, end: str) -> Column:
    """Clamp an end date to its start; an open end stays open."""
    return F.when(F.col(end).isNotNull(), F.greatest(F.col(end), F.col(start)))


def end_or_default(start: str, end: str, days: int = 365) -> Column:
    """The end date, or ``days`` after the start where it is open."""
    return F.coalesce(F.col(end), F.date_add(F.col(start), days))


def span_days(start: str, end: str, at_least: int = 1) -> Column:
    return F.greatest(F.datediff(F.col(end), F.col(start)), F.lit(at_least))


def on_day(stamp: str, day: date) -> Column:
    """True for stamps of one day, midnight to midnight."""
    first = F.lit(day)
    return (F.col(stamp) >= first) & (F.col(stamp) < F.date_add(first, 1))


def in_month(stamp: str, month: date) -> Column:
    """True for stamps of one month."""
    first = F.lit(month.replace(day=1))
    return (F.col(stamp) >= first) & (F.col(stamp) < F.add_months(first, 1))


def date_parts(stamp: str, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_date": F.to_date(stamp),
        f"{prefix}_year": F.year(stamp),
        f"{prefix}_month": F.month(stamp),
    }


def tenure(start: str, as_of: Column, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_tenure_days": F.datediff(as_of, F.col(start)),
        f"{prefix}_tenure_months": F.floor(F.months_between(as_of, F.to_date(start))).cast("int"),
    }
