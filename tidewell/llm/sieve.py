"""Keeps rows that a join cannot need out of its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import settle

BITS = 23


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id may be among ``ids``: all that are, and few others.

    A table of 2^BITS bits is all that is broadcast (2 MB), so that a later join shuffles
    few texts.  Where the ids fill the table, more rows pass and nothing is lost.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITS))
    word = F.floor(bit / 64).cast("int")
    marks = ids.select(word.alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {1 << BITS}) % 64 as int))").alias("bit"))
    table = settle(marks.groupBy("word").agg(F.bit_or("bit").alias("bits")), "bits")
    table = table.select(F.col("word").alias("__word"), F.col("bits").alias("__bits"))
    marked = F.expr(f"shiftrightunsigned(__bits, cast(pmod(xxhash64(doc_id), {1 << BITS}) % 64 as int)) & 1L") == 1
    return docs.join(F.broadcast(table), word == F.col("__word")).where(marked).drop("__word", "__bits")
