"""Format-preserving pseudonyms for personal data, in column expressions only.

A text is split at the values a pattern finds; each value that passes its check is
replaced by a keyed permutation of its own format, so equal values stay linked
across documents while separators, lengths and validity remain:

* card numbers (13 to 19 digits, Luhn): digits permuted, check digit recomputed;
* IBANs (mod 97): account characters permuted, check digits recomputed;
* IPv4 addresses: the four octets permuted together;
* dates (``2024-02-29``, ``29.02.2024``, ``29/02/2024`` or ``02/29/2024``) from 1800 to
  2199: the day number permuted within these 400 years, whatever the notation;
* phone and social-security numbers: digits permuted behind the country code;
* e-mail addresses, access keys, and values behind ``password=`` and the like: every
  letter or digit permuted within its kind, the last domain label kept.

All permutations are Feistel networks: one half is shifted by a keyed hash of the
other, which can be undone whatever the hash is, so unlike values stay unlike.
Digits that fail their check stay as they are.

Null texts stay null; texts without values stay as they are, whatever else they
hold; repeated rows are treated alike; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
# 400 years of days, as a product of two numbers
FIRST_DAY, DAY_LOW, DAY_HIGH = "1800-01-01", 5411, 27

_EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
_SECRET_NAME = r"(?i:api[_\-]?key|secret|token|password|passwd|pwd)"
_SECRET_HEAD = rf"{_SECRET_NAME}\"?\s{{0,3}}[=:]\s{{0,3}}[\"']?"
_SECRET = rf"(?<![A-Za-z]){_SECRET_HEAD}[A-Za-z0-9_\-/+]{{6,}}"
_ACCESS = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
_CARD = r"(?<!\d)\d(?:[ \-]?\d){12,18}(?![\d])"
_PHONE = (
    r"(?<![\w+])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?|\(\d{1,4}\)[ .\-]?)\d{2,4}(?:[ .\-]\d{2,4}){1,4}(?!\w)"
    r"|(?<![\w+])\+\d{8,15}(?!\w)|(?<![\w.\-])(?:\d{3} \d{3} \d{4}|\d{3}\.\d{3}\.\d{4}|\d{3}-\d{3}-\d{4})(?!\w)"
)
_DATE_ANY = r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!\d)"
PATTERN = "|".join([_EMAIL, _SECRET, _ACCESS, _IBAN, _IPV4, _DATE_ANY, _SSN, _CARD, _PHONE])


def _hash(key: str, *parts: Column) -> Column:
    """A keyed hash of some values as a number from 0 to 2^60."""
    text = F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _rounds(left: Column, right: Column, turn: Callable[[Column, Column, Column], Column]) -> Column:
    """The halves after an even number of rounds; ``turn(x, other, round)`` shifts x."""
    start = F.struct(left.alias("l"), right.alias("r"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda both, n: F.struct(both["r"].alias("l"), turn(both["l"], both["r"], n).alias("r")),
    )


def permuted(value: Column, key: str) -> Column:
    """Permute letters and digits of a text within their kind; the rest keeps its place."""

    def turn(x: Column, other: Column, n: Column) -> Column:
        def shifted(c: Column, i: Column) -> Column:
            by = _hash(key, n, i, other)

            def within(first: str, size: int) -> Column:
                return F.char(F.lit(ord(first)) + F.pmod(F.ascii(c) - F.lit(ord(first)) + by, F.lit(size)))

            return (
                F.when(c.between("0", "9") & (F.length(c) == 1), within("0", 10))
                .when(c.between("a", "z") & (F.length(c) == 1), within("a", 26))
                .when(c.between("A", "Z") & (F.length(c) == 1), within("A", 26))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.split(x, ""), shifted), "")

    half = F.floor(F.length(value) / 2).cast("int")
    done = _rounds(F.substring(value, F.lit(1), half), F.substring(value, half + 1, F.length(value)), turn)
    return F.concat(done["l"], done["r"])


def luhn_sum(digits: Column) -> Column:
    """Sum of digits in which every second one from the right counts double."""
    numbers = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(c == "", 0).when(i % 2 == 0, F.ascii(c) - 48).otherwise(F.floor((F.ascii(c) - 48) * 2 / 10) + (F.ascii(c) - 48) * 2 % 10).cast("int"),
    )
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _card(value: Column, key: str) -> Column:
    body = permuted(F.substring(value, F.lit(1), F.length(value) - 1), key)
    check = F.pmod(-luhn_sum(F.concat(_digits(body), F.lit("0"))), F.lit(10))
    return F.concat(body, check.cast("string"))


def _mod97(text: Column) -> Column:
    """The number that a text of digits and letters (A is 10) spells, modulo 97."""

    def add(rest: Column, c: Column) -> Column:
        letter = rest * 100 + F.ascii(c) - 55
        return F.when(c == "", rest).otherwise(F.when(c.between("A", "Z"), letter).otherwise(rest * 10 + F.ascii(c) - 48) % 97).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _turned(value: Column) -> Column:
    return F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, F.lit(1), F.lit(4)))


def _iban(value: Column, key: str) -> Column:
    country = F.substring(value, F.lit(1), F.lit(2))
    account = permuted(F.substring(value, F.lit(5), F.length(value)), key)
    check = F.lit(98) - _mod97(F.concat(account, country, F.lit("00")))
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)


def _ipv4(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))

    def turn(x: Column, other: Column, n: Column) -> Column:
        return F.transform(x, lambda v, i: F.pmod(v + _hash(key, n, i, F.array_join(other.cast("array<string>"), ".")), F.lit(256)).cast("int"))

    done = _rounds(F.slice(octets, 1, 2), F.slice(octets, 3, 2), turn)
    return F.array_join(F.concat(done["l"], done["r"]).cast("array<string>"), ".")


def _day(value: Column) -> Column:
    """The date a value shows, or null."""
    parsed = [F.try_to_timestamp(value, F.lit(f)).cast("date") for f in _DATE_FORMATS]
    return F.coalesce(*[F.when(value.rlike(p), d) for p, d in zip(_DATE_SHAPES, parsed)])


_DATE_SHAPES = [r"^\d{4}-", r"^\d{2}\.", r"^\d{2}/", r"^\d{2}/"]
_DATE_FORMATS = ["yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy"]


def _shifted_date(value: Column, key: str) -> Column:
    number = F.datediff(_day(value), F.lit(FIRST_DAY).cast("date"))
    low, high = F.pmod(number, F.lit(DAY_LOW)), F.floor(number / DAY_LOW).cast("int")

    def turn(x: Column, other: Column, n: Column) -> Column:
        # the halves change places every round: odd rounds move the high part
        return F.pmod(x + _hash(key, n, other), F.when(n % 2 == 1, F.lit(DAY_HIGH)).otherwise(F.lit(DAY_LOW))).cast("int")

    done = _rounds(high, low, turn)
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), done["l"] * DAY_LOW + done["r"])
    first = F.try_to_timestamp(value, F.lit("dd/MM/yyyy")).isNotNull()
    return (
        F.when(value.rlike(_DATE_SHAPES[0]), F.date_format(day, "yyyy-MM-dd"))
        .when(value.rlike(_DATE_SHAPES[1]), F.date_format(day, "dd.MM.yyyy"))
        .when(first, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
    )


def _behind(value: Column, head: str, key: str) -> Column:
    """Permute what follows the head that a pattern finds."""
    kept = F.regexp_extract(value, f"^(?:{head})", 0)
    return F.concat(kept, permuted(F.substring(value, F.length(kept) + 1, F.length(value)), key))


def _email(value: Column, key: str) -> Column:
    last = F.regexp_extract(value, r"\.[A-Za-z]+$", 0)
    return F.concat(permuted(F.substring(value, F.lit(1), F.length(value) - F.length(last)), key), last)


def pseudonym(value: Column, key: str) -> Column:
    """What stands for a value that the pattern found; the value itself if it fails its check."""
    n_digits = F.length(_digits(value))
    number = F.datediff(_day(value), F.lit(FIRST_DAY).cast("date"))
    is_card = value.rlike(r"^\d(?:[ \-]?\d){12,18}$")
    is_phone = n_digits.between(7, 15)
    return (
        F.when(value.contains("@"), _email(value, key))
        .when(value.rlike(f"^{_SECRET_HEAD}"), _behind(value, _SECRET_HEAD, key))
        .when(value.rlike(r"^(?:AKIA|ASIA)"), _behind(value, r"A[KS]IA", key))
        .when(value.rlike(r"^[A-Z]{2}\d{2}"), F.when(_mod97(_turned(value)) == 1, _iban(value, key)).otherwise(value))
        .when(value.rlike(r"^\d+\.\d+\.\d+\.\d+$"), _ipv4(value, key))
        .when(value.rlike(f"^(?:{_DATE_ANY})$"), F.when(number.between(0, DAY_LOW * DAY_HIGH - 1), _shifted_date(value, key)).otherwise(value))
        .when(is_card, F.when(luhn_sum(_digits(value)) % 10 == 0, _card(value, key)).otherwise(value))
        .when(is_phone, _behind(value, r"\+\d{1,3}(?=[ (.\-])", key))
        .otherwise(value)
    )


def pseudonymised(docs: DataFrame, key: str, column: str = "text", count: str | None = None) -> DataFrame:
    """The rows with their texts rewritten; ``count`` names a column for the values replaced."""
    text = F.col(f"`{column}`").cast("string")
    names = docs.columns
    hidden = "__values"
    while hidden in names:
        hidden += "_"
    found = docs.withColumn(hidden, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    found = found.withColumn(hidden, F.transform(F.col(hidden), lambda v: F.struct(v.alias("was"), pseudonym(v, key).alias("now"))))
    values = F.col(hidden)
    parts = F.zip_with(F.split(text, PATTERN), values, lambda part, v: F.concat(part, F.coalesce(v["now"], F.lit(""))))
    out = found.withColumn(column, F.when(F.size(values) > 0, F.array_join(parts, "")).otherwise(text))
    if count:
        out = out.withColumn(count, F.coalesce(F.size(F.filter(values, lambda v: v["was"] != v["now"])), F.lit(0)))
    return out.select(*[F.col(f"`{n}`") for n in names], *([count] if count else []))
