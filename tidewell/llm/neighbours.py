"""Nearest neighbours by collision-counting hashing.

Every vector is projected on ``PROJECTIONS`` random lines, and each line has its
projections sorted.  A query opens a window around its own projection on every
line; a vector collides on a line if it lies in the window.  Vectors that collide
on at least ``COLLIDING`` of the lines are verified: their cosine is computed on
the original numbers.  The windows widen with a radius (virtual rehashing: only
what a wider window adds is counted) until the k-th verified vector is nearer than
the radius.  The last radius is unbounded, so k neighbours are found wherever there
are k vectors.

The vectors are dealt at random into shards of about ``SHARD`` rows, the queries
into blocks; each pair of a shard and a block is one group with sorted arrays of
its own, and the k best of all groups are the result.  A group is small whatever
the vectors are, so frequent vectors or near-equal ones cost no task more.

The window is as wide as the radius: two vectors at that distance collide on a line
with a probability of 0.683, and the threshold lies 1.65 standard deviations below
the mean, so that a neighbour at the very radius is verified with a probability of
0.95, a nearer one with a higher one.

Vectors that are null, empty, zero or hold null or non-finite components take no
part; queries meet only vectors of their own length.  Rows with a query's id are not
its neighbours; of rows that repeat an id the nearest counts.  Ties go to the
smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
HIT = 0.6826895
COLLIDING = round(PROJECTIONS * HIT - 1.65 * (PROJECTIONS * HIT * (1 - HIT)) ** 0.5)
RADII = (0.5, 0.9, 1.05, 1.2, 1.35, np.inf)
SHARD = 4_096
BLOCK = 2_048


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, vector, width of the rows that take part."""
    numbers = F.col(vector).cast("array<double>")
    fine = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull())
    found = found.where(fine & F.exists(numbers, lambda x: x != 0))
    return found.select("vec_id", numbers.alias("vector"), F.size(vector).alias("width"))


def lines(width: int) -> np.ndarray:
    return np.random.default_rng(width).standard_normal((width, PROJECTIONS))


def _search(base: np.ndarray, base_ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """Places of queries and base rows, and scores, of each query's k best verified rows."""
    norms, query_norms = np.sqrt(np.einsum("ij,ij->i", base, base)), np.sqrt(np.einsum("ij,ij->i", queries, queries))
    directions = lines(base.shape[1])
    spots = (base / norms[:, None]) @ directions
    aims = (queries / query_norms[:, None]) @ directions
    order = np.argsort(spots, axis=0, kind="stable")
    arrays = [np.ascontiguousarray(order[:, j]) for j in range(PROJECTIONS)]
    ordered = np.take_along_axis(spots, order, axis=0)
    n, waiting = len(base), np.arange(len(queries))
    counts = np.zeros((len(queries), n), np.int32)
    verified = np.zeros((len(queries), n), bool)
    # windows start empty at the query's place
    low = np.stack([np.searchsorted(ordered[:, j], aims[:, j]) for j in range(PROJECTIONS)], axis=1)
    high = low.copy()
    rows: list[list[np.ndarray]] = [[] for _ in queries]
    scores: list[list[np.ndarray]] = [[] for _ in queries]
    for radius in RADII:
        wider_low = np.stack([np.searchsorted(ordered[:, j], aims[waiting, j] - radius) for j in range(PROJECTIONS)], axis=1)
        wider_high = np.stack([np.searchsorted(ordered[:, j], aims[waiting, j] + radius, "right") for j in range(PROJECTIONS)], axis=1)
        left = []
        for at, q in enumerate(waiting):
            parts = [a[x:y] for a, x, y in zip(arrays, wider_low[at], low[q])]
            parts += [a[x:y] for a, x, y in zip(arrays, high[q], wider_high[at])]
            counts[q] += np.bincount(np.concatenate(parts), minlength=n)
            new = np.flatnonzero((counts[q] >= COLLIDING) & ~verified[q])
            verified[q, new] = True
            new = new[base_ids[new] != query_ids[q]]
            if len(new):
                products = (base[new] * queries[q]).sum(axis=1)
                rows[q].append(new)
                scores[q].append(products / (norms[new] * query_norms[q]))
            best = np.concatenate(scores[q]) if scores[q] else np.empty(0)
            # enough different rows at less than the radius
            near = best >= 1 - radius * radius / 2 if np.isfinite(radius) else np.ones(len(best), bool)
            if near.sum() < k or len(np.unique(base_ids[np.concatenate(rows[q])[near]])) < k:
                left.append(at)
        low[waiting], high[waiting] = wider_low, wider_high
        waiting = waiting[left]
    for q in range(len(queries)):
        if rows[q]:
            found, score = np.concatenate(rows[q]), np.concatenate(scores[q])
            best = np.lexsort((base_ids[found], -score))
            _, first = np.unique(base_ids[found[best]], return_index=True)
            best = best[np.sort(first)[:k]]
            yield q, found[best], score[best]


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(np.float64)


def nearest(vectors: DataFrame, queries: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows by cosine of every row where
    ``queries`` (a condition) holds."""
    rows, asked = usable(vectors, vector), usable(vectors.where(queries), vector)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    shards = max(1, -(-rows.count() // SHARD))
    blocks = max(1, -(-asked.count() // BLOCK))
    dealt = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    base = rows.withColumn("shard", dealt).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # every block meets every shard: the stated queries against all rows
    dealt = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    wanted = asked.withColumn("block", dealt).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            base_ids, query_ids = (np.asarray(t.column("vec_id").combine_chunks()) for t in (left, right))
            for q, found, score in _search(_matrix(left, "vector"), base_ids, _matrix(right, "vector"), query_ids, k):
                out[0].extend([query_ids[q]] * len(found))
                out[1].extend(base_ids[found])
                out[2].extend(score)
        id_type = left.schema.field("vec_id").type
        return pa.table([pa.array(out[0], id_type), pa.array(out[1], id_type), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    keys = ["width", "shard", "block"]
    found = base.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(search, f"query_id {kind}, vec_id {kind}, score double")
    # an id that several rows share counts once
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
