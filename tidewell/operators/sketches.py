"""Profiles kept as sketches per day and merged over any range of days.

A day's sketches are written once; a question about a range reads them and merges, so
the rows are not read again.  Distinct counts come from HyperLogLog sketches, quantiles
from KLL sketches, frequent values from frequent-items sketches.  All three merge: a
range gives what one pass over its rows would, within the stated error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 2^12 registers: relative standard error 1.04 / sqrt(2^12).
HLL_BITS = 12
HLL_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
# Rank error of a KLL sketch of this k, at 99 % confidence.
KLL_K = 200
KLL_ERROR = 0.0133
# Values that a frequent-items sketch tracks.
TRACKED = 1000


def daily_sketches(
    df: DataFrame, day: str, distinct: Sequence[str] = (), numbers: Sequence[str] = (), frequent: Sequence[str] = ()
) -> DataFrame:
    """One row per day: ``n``, and ``<column>_hll``, ``_kll`` and ``_top`` sketches.

    Partial sketches are built where the rows lie; only sketches are shuffled.  Days without
    values have null sketches, which merge as nothing.
    """
    found = [F.count("*").alias("n")]
    found += [F.hll_sketch_agg(F.col(c), HLL_BITS).alias(f"{c}_hll") for c in distinct]
    found += [F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_K).alias(f"{c}_kll") for c in numbers]
    found += [F.call_function("approx_top_k_accumulate", F.col(c), F.lit(TRACKED)).alias(f"{c}_top") for c in frequent]
    return df.groupBy(F.col(day).alias("day")).agg(*found)


def merged_sketches(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of all given days as one, per group of ``by``."""
    merges = {
        "_hll": lambda c: F.hll_union_agg(c),
        "_kll": lambda c: F.kll_merge_agg_double(c),
        "_top": lambda c: F.call_function("approx_top_k_combine", c, F.lit(TRACKED)),
    }
    merged = [F.sum("n").alias("n")]
    merged += [merges[c[-4:]](F.col(c)).alias(c) for c in days.columns if c[-4:] in merges]
    return days.groupBy(*by).agg(*merged)


def estimates(sketches: DataFrame, quantiles: Mapping[str, float] | None = None, top: int = 10) -> DataFrame:
    """What sketches tell: ``<column>_distinct``, ``<column>_<name>`` per quantile, ``<column>_frequent``."""
    quantiles = quantiles or {"median": 0.5}
    told = []
    for c in sketches.columns:
        name, kind = c[:-4], c[-4:]
        if kind == "_hll":
            told.append(F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(f"{name}_distinct"))
        elif kind == "_kll":
            told += [F.kll_sketch_get_quantile_double(c, F.lit(q)).alias(f"{name}_{label}") for label, q in quantiles.items()]
        elif kind == "_top":
            told.append(F.call_function("approx_top_k_estimate", F.col(c), F.lit(top)).alias(f"{name}_frequent"))
        else:
            told.append(F.col(c))
    return sketches.select(*told)
