"""Latest row per business grain, and the rows it supersedes.

Neither form gathers a whole grain in one task.  ``latest`` filters on
``row_number() = 1`` directly above the window, so that Spark keeps one row per
grain and map task before it shuffles.  ``mark_latest`` must number every row;
it ranks inside (grain, input partition) first and lets only the winners of
those lanes meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _LANE, _RIVAL, _PLACE = "__rank", "__lane", "__rival", "__place"


def _newest_first(df: DataFrame, grain: Sequence[str], order: Sequence[str]) -> list[Column]:
    """Order columns newest first, then every other column, so that ties between
    different rows are always broken the same way."""
    rest = [
        name
        for name, dtype in df.dtypes
        if name not in {*grain, *order} and "map<" not in dtype and dtype != "variant"
    ]
    # rows that have nothing but their grain are alike
    return [F.col(c).desc_nulls_last() for c in order] + [F.col(c).asc_nulls_first() for c in rest] or [F.lit(0).asc()]


def latest(df: DataFrame, grain: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per grain: the highest in ``order``."""
    window = Window.partitionBy(*grain).orderBy(*_newest_first(df, grain, order))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def mark_latest(
    df: DataFrame,
    grain: Sequence[str],
    order: Sequence[str],
    flag: str = "is_latest",
    among: Column | None = None,
    gathered: bool = False,
) -> DataFrame:
    """Add a flag that is true for the row ``latest`` would keep.

    ``among`` restricts the contest: rows where it is not true never win and
    never compete.  ``gathered`` says that no grain is too large for one task, as
    ``split_hot`` sees to; rows are then ranked once, where they lie if a column
    of the grain has dealt them.
    """
    newest = _newest_first(df, grain, order)
    contest = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    if gathered:
        whole = Window.partitionBy(*grain, _RIVAL).orderBy(*newest)
        won = F.col(_RIVAL) & (F.row_number().over(whole) == 1)
        return df.withColumn(_RIVAL, contest).withColumn(flag, won).drop(_RIVAL)
    laned = df.withColumns({_LANE: F.spark_partition_id(), _RIVAL: contest})
    inside = Window.partitionBy(*grain, _RIVAL, _LANE).orderBy(*newest)
    ranked = laned.withColumn(_RANK, F.row_number().over(inside))
    # Winners of their lane meet in lane -1; all others stay where they are.
    ranked = ranked.withColumn(
        _LANE, F.when(F.col(_RIVAL) & (F.col(_RANK) == 1), F.lit(-1)).otherwise(F.col(_LANE))
    )
    across = Window.partitionBy(*grain, _RIVAL, _LANE).orderBy(*newest)
    won = (F.col(_LANE) == -1) & (F.row_number().over(across) == 1)
    return ranked.withColumn(flag, won).drop(_RANK, _LANE, _RIVAL)


# Keys are counted by hash in so many places; a place is hot with so many rows and this many
# times the mean.
PLACES, HOT_ROWS, HOT_SHARE = 1 << 16, 20_000, 8


def split_hot(df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys one task can take, and rows of places that hold a hot key.

    Rows of one key, null like any other, are on the same side.
    """
    dealt = df.withColumn(_PLACE, F.pmod(F.xxhash64(key), F.lit(PLACES)))
    # one row per place
    counts = dealt.groupBy(_PLACE).agg(F.count("*").alias("__n"))
    mean = F.sum("__n").over(Window.partitionBy(F.lit(0))) / PLACES
    crowded = counts.withColumn("__mean", mean).filter(F.col("__n") > HOT_ROWS + HOT_SHARE * F.col("__mean"))
    hot = F.broadcast(crowded.select(_PLACE))
    return tuple(dealt.join(hot, _PLACE, how).drop(_PLACE) for how in ("left_anti", "left_semi"))


def superseded(df: DataFrame, grain: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row that ``latest`` leaves out, copies included."""
    return mark_latest(df, grain, order, "__keep").filter(~F.col("__keep")).drop("__keep")


def split_latest(
    df: DataFrame, grain: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    return latest(df, grain, order), superseded(df, grain, order)
