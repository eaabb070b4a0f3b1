"""Lenient casts: text that does not fit the type becomes null, never an error."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lenient(column: str | Column, dtype: str) -> Column:
    source = F.col(column) if isinstance(column, str) else column
    return source.try_cast(dtype)


def typed_select(df: DataFrame, schema: Mapping[str, str], carry: Iterable[str] = ()) -> DataFrame:
    """Cast and keep exactly the columns of ``schema`` (and those to carry along).

    A key may rename: ``{"created_at <- dw_created_at": "timestamp"}``.
    """
    picked = []
    for name, dtype in schema.items():
        target, _, source = (part.strip() for part in name.partition("<-"))
        picked.append(lenient(source or target, dtype).alias(target))
    return df.select(*picked, *[F.col(c) for c in carry])


def typed_columns(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast the columns of ``schema`` in place and keep every other column."""
    return df.withColumns({name: lenient(name, dtype) for name, dtype in schema.items()})


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty or blank text becomes null in every string column."""
    text = [name for name, dtype in df.dtypes if dtype == "string"]
    return df.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c in text})


def number_or_null(column: str | Column) -> Column:
    """NaN becomes null."""
    source = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(source), source)


# Stands for a replacement character that was in the text; these code points are
# no characters and are not meant for exchange.
_GENUINE = "\ufdd0\ufdd1\ufdd0"


def utf8_text(column: str | Column) -> Column:
    """Decode bytes as UTF-8 and leave out the bytes that are not valid."""
    source = F.col(column) if isinstance(column, str) else column
    held = F.replace(source.cast("string"), F.lit("\ufffd"), F.lit(_GENUINE))
    valid = F.replace(F.make_valid_utf8(held), F.lit("\ufffd"), F.lit(""))
    return F.replace(valid, F.lit(_GENUINE), F.lit("\ufffd"))
