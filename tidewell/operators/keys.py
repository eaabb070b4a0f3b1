"""Numbering and neighbours without a single-task sort.

Spark's range partitioning cuts the order into even pieces, also where one key
or one moment holds a third of the rows.  The sorted pieces are written to the
shared folder with their numbers, so that every later read sees the same cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import settle

_ID, _PIECE, _OFFSET, _TIE = "__id", "__piece", "__offset", "__tie"
# monotonically_increasing_id keeps the partition above this many bits.
_PIECE_BITS = 33


def surrogate_keys(
    df: DataFrame, order: Sequence[str], name: str = "surrogate_key", start_after: int = 0
) -> DataFrame:
    """Contiguous numbers from ``start_after + 1`` in the given order.

    Rows that tie in the whole order are numbered in any order among them; their
    place in the input comes last in the order, so that ties are cut evenly too.
    """
    placed = [*order, _TIE]
    spread = df.withColumn(_TIE, F.xxhash64(F.monotonically_increasing_id()))
    sorted_pieces = spread.repartitionByRange(*placed).sortWithinPartitions(*placed).drop(_TIE)
    rows = settle(sorted_pieces.withColumn(_ID, F.monotonically_increasing_id()), "numbered")
    piece = F.shiftright(_ID, _PIECE_BITS)
    sizes = rows.groupBy(piece.alias(_PIECE)).agg(F.count("*").alias("__size"))
    # One row per shuffle partition, whatever the size of the data.
    before = Window.orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PIECE, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias(_OFFSET))
    inside = F.col(_ID) - F.shiftleft(F.col(_PIECE), _PIECE_BITS)
    return (
        rows.withColumn(_PIECE, piece)
        .join(F.broadcast(offsets), _PIECE)
        .withColumn(name, F.col(_OFFSET) + inside + F.lit(start_after + 1))
        .select(*df.columns, name)
    )


def paginate(df: DataFrame, order: Sequence[str], size: int, name: str = "page") -> DataFrame:
    """Page number of every row when read in order, ``size`` rows a page."""
    numbered = surrogate_keys(df, order, "__seq")
    return numbered.withColumn(name, F.floor((F.col("__seq") - 1) / size)).drop("__seq")


def one_page(df: DataFrame, order: Sequence[str], offset: int, size: int) -> DataFrame:
    """One page of the ordered rows, found by number, so that no task gathers the
    pages before it."""
    numbered = surrogate_keys(df, order, "__seq")
    inside = (F.col("__seq") > offset) & (F.col("__seq") <= offset + size)
    return numbered.filter(inside).drop("__seq")


def previous_value(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """The value of the row before, per key.

    Rows are numbered by key and order; the row before is the one with the
    number before, if it has the same key.  That join is on unique numbers, so
    a key's rows never meet in one task.
    """
    rows = surrogate_keys(df, [*key, *order], "__seq")
    before = rows.select(
        (F.col("__seq") + 1).alias("__next"),
        F.col(value).alias("__value"),
        *[F.col(k).alias(f"__key_{k}") for k in key],
    )
    same_key = F.lit(True)
    for k in key:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    joined = rows.join(before, F.col("__seq") == F.col("__next"), "left")
    return joined.withColumn(name, F.when(same_key, F.col("__value"))).select(*df.columns, name)
