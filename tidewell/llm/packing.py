"""Bound-certified best-fit packing of documents into fixed sequences.

Documents become pieces (ids, then a closing id; only longer ones are cut).  The
pieces, without their text, are dealt into groups; each group is packed best-fit
decreasing, and dual feasible functions bound from below how many sequences it
needs.  A group that reaches its bound is certified and final.  The others
release the sequences that are not full; these are dealt anew, whole sequences
together, and packed again.  A group keeps its old sequences if the new ones are
not fewer, so a round never loses.

Null texts are empty documents of one closing id.  Repeated rows are packed once
each; ties are broken by (doc_id, piece, checksum).  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.tokens import Encoder
from tidewell.llm.workers import slices
from tidewell.session import settle

SEQUENCE = 2048
CLOSING_ID = 0
GROUP_PIECES = 2048
ROUNDS = 4


def _bytes_of(ids: list[int]) -> bytes:
    return np.asarray(array("I", ids), "<u4").tobytes()


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces."""

    def encode(batches):
        encoder = Encoder(path)
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # whole: most pieces of a text are too rare for a cache to pay
                ids = _bytes_of([*encoder.ids(text or ""), CLOSING_ID])
                total = len(ids) // 4
                start, length, piece = 0, total % size or size, 0
                while start < total:
                    part = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(out, (doc, piece, start, length, zlib.crc32(part), part)):
                        column.append(value)
                    start, length, piece = start + length, size, piece + 1
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 6 if keep_ids else 5
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out[:n], kinds)], names[:n])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(encode, schema)


def lower_bound(lengths: np.ndarray, size: int = SEQUENCE) -> int:
    """Sequences that any packing needs, by dual feasible functions.

    Two families: lengths above ``size - e`` count as whole sequences while those
    below ``e`` count nothing, and lengths rounded down to parts of ``size / k``.
    """
    if not len(lengths):
        return 0
    x = np.sort(np.asarray(lengths, np.int64))
    total = np.concatenate([[0], np.cumsum(x)])
    best = -(-int(total[-1]) // size)
    e = np.unique(np.concatenate([x[x <= size // 2], [1]]))
    low, high = np.searchsorted(x, e, "left"), np.searchsorted(x, size - e, "right")
    worth = total[high] - total[low] + size * (len(x) - high)
    best = max(best, int((-(-worth // size)).max()))
    for k in range(1, 33):
        scaled = (k + 1) * x
        # in units of 1 / (k * size): whole multiples keep their length
        value = np.where(scaled % size == 0, k * x, scaled // size * size)
        best = max(best, -(-int(value.sum()) // (k * size)))
    return best


def best_fit(lengths: list[int], size: int = SEQUENCE) -> list[int]:
    """Sequence number of each length, taken in the given order.

    ``room`` has a bit for every free length that some sequence has, so the
    tightest one is the lowest bit at or above the length.
    """
    with_free: list[list[int]] = [[] for _ in range(size + 1)]
    room, opened, placed = 0, 0, []
    for length in lengths:
        fitting = room >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = with_free[free].pop()
            if not with_free[free]:
                room ^= 1 << free
        else:
            free, number, opened = size, opened, opened + 1
        left = free - length
        if not with_free[left]:
            room |= 1 << left
        with_free[left].append(number)
        placed.append(number)
    return placed


def _pack_groups(dealt: DataFrame, step: int, size: int) -> DataFrame:
    """Pack every group; ``gap`` is how far it may be from its bound, 0 where certified."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32", "sequence_id"], ascending=[False, True, True, True, True], kind="stable")
        lengths = frame["length"].to_numpy()
        placed = np.asarray(best_fit(lengths.tolist(), size), np.int64)
        bins, bound = int(placed.max()) + 1, lower_bound(lengths, size)
        old = frame["sequence_id"].to_numpy()
        if step and len(np.unique(old)) <= bins:
            placed, bins = old, len(np.unique(old))
        else:
            placed = (np.int64(step) << 58) + (frame["deal"].to_numpy() << 20) + placed
        return frame.assign(sequence_id=placed, gap=np.int64(bins - bound)).drop(columns="deal")

    schema = ", ".join(f"{n} {t}" for n, t in dealt.dtypes if n not in ("deal", "gap")) + ", gap long"
    return dealt.groupBy("deal").applyInPandas(pack, schema)


def pack(items: DataFrame, size: int = SEQUENCE, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Add sequence_id and offset to ``items(doc_id, piece, start, length, ids_crc32)``."""
    full = items.where(F.col("length") >= size)
    open_ = items.where(F.col("length") < size).withColumn("sequence_id", F.lit(0).cast("long"))
    # pieces that fill a sequence alone
    done = [full.withColumn("sequence_id", -F.monotonically_increasing_id() - 1)]
    for step in range(rounds):
        count = open_.count()
        if not count:
            break
        groups = -(-count // group_pieces)
        # dealt by row at first, so that no key is hot; then whole sequences together
        key = F.xxhash64("sequence_id", F.lit(step)) if step else F.xxhash64(F.monotonically_increasing_id())
        dealt = open_.withColumn("deal", F.pmod(key, F.lit(groups).cast("long")))
        packed = settle(_pack_groups(dealt, step, size), f"packed-{step}")
        if step == rounds - 1 or groups == 1:
            done.append(packed.drop("gap"))
            break
        fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
        # certified groups are final; others give their sequences with room
        loose = fill.where(F.col("fill") < size).select("sequence_id")
        with_gap = F.col("gap") > 0
        done.append(packed.where(~with_gap).drop("gap"))
        done.append(packed.where(with_gap).join(loose, "sequence_id", "left_anti").select(packed.drop("gap").columns))
        open_ = packed.where(with_gap).join(loose, "sequence_id", "left_semi").select(packed.drop("gap").columns)
        open_ = settle(open_, f"released-{step}")
    columns = [*items.columns, "sequence_id"]
    placed = done[0].select(columns)
    for part in done[1:]:
        placed = placed.unionByName(part.select(columns))
    return with_offsets(placed)


def with_offsets(placed: DataFrame) -> DataFrame:
    """Lay the pieces of each sequence end to end; a sequence has at most its size in pieces."""
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))


def pack_documents(docs: DataFrame, path: str, size: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return pack(settle(pieces(docs, path, size), "pieces"), size)
