"""Divergence of a language's sources by exact term shares, with terms as digests.

A first pass counts the documents of every (language, 64-bit digest of a term); nothing
but these fixed-width rows is shuffled.  The digests that enough documents hold are kept;
they mark the bits of a table of fixed size and are cut into blocks by their first bits.
A second pass counts the terms that the table lets through per (lang, source), in bounded
memory, and sends arrays of digests and counts to their block, where they are added up
as they stream by.  Each distinct string goes to its block once per task: where the least and
the greatest string of a digest differ, terms collide.  Then a further pass counts the
strings of those digests alone, and each becomes a term of its own.  Shares, distances and ranks are
computed on blocks; strings are joined back to the terms that are reported.

Null text, lang and source are ''.  A term is a run of ASCII letters and of characters
beyond ASCII, with A-Z in lower case.  A language keeps the terms that at least ``least``
of its documents hold; every row is a document, so a repeated row counts again.  Shares
are whole numbers of billionths, and divergences are whole numbers, so no result depends on an
order.  An empty table gives no rows; columns besides text, lang and source are not read.

Sources are compared in tiles: a block of terms and two tiles of sources make a matrix of
bounded size, so neither a hot source nor many sources meet in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.workers import slices
from tidewell.session import settle

LEAST_DOCUMENTS = 10
RANKS = 10
BILLION = 1_000_000_000
# Distinct (group, term) that a task holds before it looks which may be kept.
COUNTED_PER_TASK = 300_000
# Digests that a task gathers before it counts them.
GATHERED_PER_TASK = 4_000_000
# The table of digests that may be kept has 2^SIEVE_BITS bits (8 MB) at any size; where
# the kept terms fill it, more rows pass and nothing is lost.
SIEVE_BITS = 26
# Terms of a block and sources of a tile; a matrix has about twice their product of cells.
BLOCK_TERMS = 4_096
TILE_SOURCES = 256

Digest = Callable[[bytes], int]
GROUP = ["lang", "source"]
BLOCK = ["lang", "block"]
_COUNT = "decimal(38,0)"
# longs in arrays are written with the high byte first, as Spark writes their hex digits
_LONG = np.dtype(">i8")

# bytes that are in no term become spaces, A-Z become a-z
_IN_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _read(docs: DataFrame, *columns: str) -> DataFrame:
    """Text as bytes and the named columns, nulls as ''."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    return docs.select(F.col("text").cast("string").cast("binary"), *named)


def _digests(terms: Iterable[bytes], digest: Digest) -> np.ndarray:
    return np.fromiter(map(digest, terms), np.uint64).view(np.int64)


def candidates(docs: DataFrame, least: int = LEAST_DOCUMENTS, digest: Digest = xxhash.xxh64_intdigest) -> DataFrame:
    """lang, digest of the terms that at least ``least`` documents of a language hold."""

    def count(batches):
        gathered: dict[str, list[np.ndarray]] = {}
        size = 0

        def flushed():
            for lang, found in gathered.items():
                digests, held = np.unique(np.concatenate(found), return_counts=True)
                columns = [pa.array([lang] * len(digests), pa.string()), pa.array(digests), pa.array(held, pa.int64())]
                yield pa.record_batch(columns, ["lang", "digest", "documents"])

        for batch in slices(batches):
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                # terms of one document whose digests collide count once
                found = np.unique(_digests(set((text or b"").translate(_IN_TERMS).split()), digest))
                gathered.setdefault(lang, []).append(found)
                size += len(found)
                if size > GATHERED_PER_TASK:
                    yield from flushed()
                    gathered, size = {}, 0
        yield from flushed()

    counted = _read(docs, "lang").mapInArrow(count, "lang string, digest long, documents long")
    held = counted.groupBy("lang", "digest").agg(F.sum("documents").alias("documents"))
    return held.where(F.col("documents") >= least).select("lang", "digest")


def sieve(digests: DataFrame) -> np.ndarray:
    """A table of bits, 64 to a number, in which every digest's bit is set."""
    bit = F.pmod(F.col("digest"), F.lit(1 << SIEVE_BITS))
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    words = digests.select(F.call_function("div", bit, F.lit(64)).alias("word"), mark.alias("mark"))
    marked = words.groupBy("word").agg(F.bit_or("mark").alias("marks")).toArrow()
    table = np.zeros(1 << SIEVE_BITS - 6, np.int64)
    table[marked["word"].to_numpy()] = marked["marks"].to_numpy()
    return table


def passes(digests: np.ndarray, table: np.ndarray) -> np.ndarray:
    bit = digests & (64 * len(table) - 1)
    return (table[bit >> 6] >> (bit & 63) & 1).astype(bool)


def _block(digests: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of a digest."""
    return (digests.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(digests), np.int64)


def _bytes(column: str) -> Column:
    """A long as an array of one."""
    return F.unhex(F.lpad(F.hex(column), 16, "0"))


def _block_of(digest: Column, bits: int) -> Column:
    return (F.shiftrightunsigned(digest, 64 - bits) if bits else F.lit(0)).cast("int")


def _passing_counts(docs: DataFrame, table: np.ndarray, digest: Digest, finish: Callable, schema: str) -> DataFrame:
    """Rows that ``finish`` makes of each task's ``(lang, source), terms, digests, counts, documents``.

    Terms whose digests don't pass the table are dropped.  ``finish`` gets all of a task's
    groups at once, or as many as fit its memory.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches):
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def passing() -> list:
            found = []
            for key, (n, held) in groups.items():
                terms = list(n)
                digests = _digests(terms, digest)
                kept = np.flatnonzero(passes(digests, shared.value))
                terms = [terms[k] for k in kept.tolist()]
                groups[key] = Counter({t: n[t] for t in terms}), Counter({t: held[t] for t in terms})
                found.append((key, terms, digests[kept], *groups[key]))
            return found

        for batch in slices(batches):
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns)):
                n, held = groups.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                terms = (text or b"").translate(_IN_TERMS).split()
                n.update(terms)
                if counts_documents:
                    held.update(set(terms))
                size += len(n)
                if size + len(groups) > COUNTED_PER_TASK:
                    found = passing()
                    size = sum(len(terms) for _, terms, *_ in found)
                    if size + len(groups) > COUNTED_PER_TASK // 2:
                        yield from finish(found)
                        groups, size = {}, 0
        yield from finish(passing())

    counts_documents = "documents" in schema
    return _read(docs, *GROUP).mapInArrow(count, schema)


_ARRAYS = "lang string, source string, block int, ids binary, counts binary, terms array<string>"


def block_counts(docs: DataFrame, table: np.ndarray, bits: int, digest: Digest) -> DataFrame:
    """Arrays of digests and counts per task, group and block, and of strings per task and block.

    Rows without lang hold strings.  A row without block marks a group that occurs.
    """

    def arrays(found):
        columns: list[list] = [[], [], [], [], [], []]

        def add(lang, source, digests, counts, terms):
            order = np.argsort(digests, kind="stable")
            digests = digests[order]
            blocks = _block(digests, bits)
            # many short rows, so that a batch of them stays small
            starts = np.flatnonzero((np.diff(blocks, prepend=-1) != 0) | (np.arange(len(blocks)) % 1024 == 0)).tolist()
            for begin, end in zip(starts, [*starts[1:], len(blocks)]):
                part = order[begin:end]
                own = None if counts is None else counts[part].astype(_LONG).tobytes()
                names = None if terms is None else [terms[k] for k in part.tolist()]
                values = lang, source, int(blocks[begin]), digests[begin:end].astype(_LONG).tobytes(), own, names
                for column, value in zip(columns, values):
                    column.append(value)

        seen: dict[bytes, int] = {}
        for (lang, source), terms, digests, n, _ in found:
            for column, value in zip(columns, (lang, source, None, None, None, None)):
                column.append(value)
            add(lang, source, digests, np.fromiter(map(n.__getitem__, terms), np.int64, len(terms)), None)
            seen.update(zip(terms, digests.tolist()))
        add(None, None, np.fromiter(seen.values(), np.int64, len(seen)), None, list(seen))
        kinds = [pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string())]
        names = [c.split()[0] for c in _ARRAYS.split(", ")]
        for begin in range(0, len(columns[0]), 256):
            yield pa.record_batch([pa.array(c[begin : begin + 256], k) for c, k in zip(columns, kinds)], names)

    return _passing_counts(docs, table, digest, arrays, _ARRAYS)


def string_counts(docs: DataFrame, table: np.ndarray, digest: Digest) -> DataFrame:
    """lang, source, term, digest, n, documents of all strings whose digests pass the table."""

    def rows(found):
        for (lang, source), terms, digests, n, held in found:
            columns = [pa.array([x] * len(terms), pa.string()) for x in (lang, source)] + [pa.array(terms, pa.binary()), pa.array(digests)]
            columns += [pa.array([*map(c.__getitem__, terms)], pa.int64()) for c in (n, held)]
            yield pa.record_batch(columns, ["lang", "source", "term", "digest", "n", "documents"])

    schema = "lang string, source string, term binary, digest long, n long, documents long"
    found = _passing_counts(docs, table, digest, rows, schema).withColumn("term", F.col("term").cast("string"))
    return found.groupBy(*GROUP, "term", "digest").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


_SUMS = "lang string, source string, block int, ids binary, counts binary, n long, digest long, low string, high string"


def block_sums(arrays: DataFrame, kept: DataFrame) -> DataFrame:
    """What streams to each block, added up.

    One row of counts per group and block, in the order of the block's kept ids; one per
    language and block, without source, with the ids and their counts in the whole language; one
    per digest with its least and greatest string; and those that mark groups.
    """
    ids = kept.select("lang", F.lit(None).cast("string").alias("source"), "block", _bytes("id").alias("ids"))
    rows = arrays.unionByName(ids, allowMissingColumns=True)
    # kept ids come first in their block, as they have no source
    # marks of groups need not meet in their language
    ordered = rows.repartition(*BLOCK, F.when(F.col("block").isNull(), F.col("source"))).sortWithinPartitions("lang", "block", "source")
    names = [c.split()[0] for c in _SUMS.split(", ")]

    def add_up(batches):
        at, source, kept_ids, total, own = None, None, [], None, None
        strings: dict[int, tuple[str, str]] = {}

        def group_row():
            return pa.record_batch(
                [*(pa.array([x], k) for x, k in ((at[0], pa.string()), (source, pa.string()), (at[1], pa.int32()))),
                 pa.nulls(1, pa.binary()), pa.array([own.astype(_LONG).tobytes()], pa.binary()), pa.array([int(own.sum())], pa.int64()),
                 pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string())], names)

        def block_rows():
            if strings:
                n = len(strings)
                empty = [pa.nulls(n, k) for k in (pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64())]
                low, high = zip(*strings.values())
                yield pa.record_batch([*empty, pa.array(strings, pa.int64()), pa.array(low, pa.string()), pa.array(high, pa.string())], names)
            if total is not None:
                columns = [pa.array([at[0]], pa.string()), pa.nulls(1, pa.string()), pa.array([at[1]], pa.int32())]
                columns += [pa.array([x.astype(_LONG).tobytes()], pa.binary()) for x in (kept_ids, total)]
                columns += [pa.array([int(total.sum())], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string())]
                yield pa.record_batch(columns, names)

        for batch in batches:
            for lang, origin, block, digests, counts, terms in (tuple(c[n].as_py() for c in batch.columns) for n in range(batch.num_rows)):
                if at != (lang, block) or origin != source:
                    if own is not None:
                        total += own
                        yield group_row()
                    own = None
                if at != (lang, block):
                    if at is not None:
                        yield from block_rows()
                    at, kept_ids, total = (lang, block), [], None
                    strings.clear()
                source = origin
                if block is None:
                    yield pa.record_batch([pa.array([x], pa.string()) for x in (lang, origin)] + [pa.nulls(1, k) for k in BARE], names)
                elif terms is not None:
                    for digest, term in zip(np.frombuffer(digests, _LONG).tolist(), terms):
                        low, high = strings.setdefault(digest, (term, term))
                        if low != term or high != term:
                            strings[digest] = min(low, term, key=str.encode), max(high, term, key=str.encode)
                elif counts is None:
                    kept_ids.append(digests)
                else:
                    if total is None:
                        kept_ids = np.sort(np.frombuffer(b"".join(kept_ids), _LONG).astype(np.int64))
                        total = np.zeros(len(kept_ids), np.int64)
                    if own is None:
                        own = np.zeros(len(kept_ids), np.int64)
                    if len(kept_ids):
                        found = np.frombuffer(digests, _LONG).astype(np.int64)
                        place = np.minimum(np.searchsorted(kept_ids, found), len(kept_ids) - 1)
                        mine = kept_ids[place] == found
                        own[place[mine]] += np.frombuffer(counts, _LONG)[mine]
        if own is not None:
            total += own
            yield group_row()
        if at is not None:
            yield from block_rows()

    BARE = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return ordered.select("lang", "source", "block", "ids", "counts", "terms").mapInArrow(add_up, _SUMS)


def share(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """One plus the whole billionths of counts smoothed by two."""
    if n.max(initial=0) > (1 << 63) // BILLION - 3:
        n = n.astype(object)
    return (BILLION * (n + 2) // (total + 2 * kept) + 1).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _marking_terms(sums: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """lang, source, block, id, value of the terms that may be among a group's first ``ranks``."""
    whole = sums.where(F.col("source").isNull()).select(*BLOCK, "ids", F.col("counts").alias("whole"))
    rows = sums.where(F.col("source").isNotNull()).select(*GROUP, "block", "counts").join(whole, BLOCK)
    rows = rows.join(groups.select(*GROUP, "total", "total_lang", "kept"), GROUP)
    rows = rows.select(*GROUP, "block", "ids", "counts", "whole", "total", "total_lang", "kept")

    def mark(batches):
        for batch in batches:
            for lang, source, block, *arrays, total, total_lang, kept in zip(*(c.to_pylist() for c in batch.columns)):
                ids, n, whole = (np.frombuffer(x, _LONG).astype(np.int64) for x in arrays)
                p, q = share(n, int(total), kept), share(whole, int(total_lang), kept)
                above = np.flatnonzero((n > 0) & (p > q))
                value = divergence(p[above], q[above])
                # ties at the last rank stay until their strings decide
                if len(value) > ranks:
                    best = value >= np.partition(value, -ranks)[-ranks]
                    above, value = above[best], value[best]
                columns = [pa.array([lang] * len(value), pa.string()), pa.array([source] * len(value), pa.string())]
                columns += [pa.array([block] * len(value), pa.int32()), pa.array(ids[above]), pa.array(value)]
                yield pa.record_batch(columns, ["lang", "source", "block", "id", "value"])

    return rows.mapInArrow(mark, "lang string, source string, block int, id long, value long")


def _pair_sums(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: divergences of all pairs of sources, summed over kept terms."""
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE_SOURCES).cast("int").alias("tiles"))
    stated = groups.select(*GROUP, "total", "kept").join(tiles, "lang")
    # every source in each pair of tiles that it belongs to
    own = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    stated = stated.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    stated = stated.withColumn("tile_a", F.least("own", "other")).withColumn("tile_b", F.greatest("own", "other"))
    blocks = sums.where(F.col("source").isNull()).select(*BLOCK, (F.length("ids") / 8).cast("int").alias("terms"))
    rows = stated.join(blocks, "lang").join(sums.where(F.col("source").isNotNull()).select(*GROUP, "block", "counts"), [*GROUP, "block"], "left")

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        names, own = frame["source"].to_numpy(object), frame["own"].to_numpy()
        matrix = np.empty((len(frame), frame["terms"].iloc[0]), np.int64)
        for n, (counts, total, kept) in enumerate(zip(frame["counts"], frame["total"], frame["kept"])):
            held = np.zeros(1, np.int64) if counts is None else np.frombuffer(counts, _LONG).astype(np.int64)
            matrix[n] = share(held, int(total), int(kept))
        tile_a, tile_b = frame["tile_a"].iloc[0], frame["tile_b"].iloc[0]
        pairs, values = [np.empty((2, 0), np.int64)], [np.empty(0, np.int64)]
        for n in np.flatnonzero(own == tile_a):
            others = np.flatnonzero(own == tile_b)
            if tile_a == tile_b:
                others = others[others > n]
            values.append(divergence(matrix[others], matrix[n]).sum(axis=1))
            pairs.append(np.stack([np.full(len(others), n), others]))
        one, two = np.concatenate(pairs, axis=1)
        both = {"source": np.append(names[one], names[two]), "item": np.append(names[two], names[one]), "value": np.tile(np.concatenate(values), 2)}
        return pd.DataFrame({"lang": np.full(2 * len(one), frame["lang"].iloc[0], object), **both})

    partial = rows.groupBy(*BLOCK, "tile_a", "tile_b").applyInPandas(add_up, "lang string, source string, item string, value long")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _split(docs: DataFrame, collided: DataFrame, least: int, digest: Digest) -> tuple[DataFrame, DataFrame]:
    """Kept ids with their strings, and arrays of counts, for the strings of colliding digests."""
    found = string_counts(docs, sieve(collided), digest).join(collided, "digest", "left_semi")
    found = settle(found, "string-counts")
    held = found.groupBy("lang", "term").agg(F.sum("documents").alias("held")).where(F.col("held") >= least).drop("held")
    # numbers that Spark gives out are distinct, and negative blocks are theirs alone
    held = settle(held.withColumn("id", F.monotonically_increasing_id()), "split-terms")
    blocks = max(1, -(-held.count() // BLOCK_TERMS))
    held = held.withColumn("block", (-1 - F.pmod(F.xxhash64("term"), F.lit(blocks))).cast("int"))
    arrays = found.join(held, ["lang", "term"]).select(*GROUP, "block", _bytes("id").alias("ids"), _bytes("n").alias("counts"))
    return held.select("lang", "block", "id", "term"), arrays


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS, digest: Digest = xxhash.xxh64_intdigest) -> DataFrame:
    """lang, source, part, item, value, rank: distances of sources and the terms that mark them."""
    kept = settle(candidates(docs, least, digest), "kept-digests")
    most = kept.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    bits = max(0, (most - 1) // BLOCK_TERMS).bit_length()
    kept = kept.select("lang", _block_of(F.col("digest"), bits).alias("block"), F.col("digest").alias("id"))
    arrays = block_counts(docs, sieve(kept.select(F.col("id").alias("digest"))), bits, digest)
    found = settle(block_sums(arrays, kept), "block-sums")
    strings = found.where(F.col("low").isNotNull()).select("digest", "low", "high")
    names = strings.select(F.col("digest").alias("id"), F.lit(False).alias("split"), F.col("low").alias("item"))
    collided = strings.where(F.col("low") != F.col("high")).select("digest")
    if not collided.isEmpty():
        held, further = _split(docs, collided, least, digest)
        kept = kept.join(collided, F.col("id") == F.col("digest"), "left_anti").unionByName(held.drop("term"))
        found = settle(block_sums(arrays.unionByName(further, allowMissingColumns=True), kept), "block-sums")
        names = names.unionByName(held.select("id", F.lit(True).alias("split"), F.col("term").alias("item")))

    sums = found.where(F.col("counts").isNotNull() & (F.length("counts") > 0))
    totals = sums.groupBy(*GROUP).agg(F.sum(F.col("n").cast(_COUNT)).cast(_COUNT).alias("total"))
    langs = sums.where(F.col("source").isNull()).groupBy("lang").agg(F.sum((F.length("ids") / 8).cast("long")).alias("kept"))
    langs = langs.join(totals.where(F.col("source").isNull()).select("lang", F.col("total").alias("total_lang")), "lang")
    groups = found.where(F.col("block").isNull() & F.col("lang").isNotNull()).select(*GROUP).distinct()
    groups = groups.join(totals, GROUP, "left").join(langs, "lang", "left").na.fill(0, ["kept"])
    groups = settle(groups.withColumn("total", F.coalesce("total", F.lit(0).cast(_COUNT))), "groups")

    by_value, by_item = (Window.partitionBy(*GROUP).orderBy(F.desc("value"), *more) for more in ((), ("item",)))
    marking = _marking_terms(sums, groups, ranks).withColumn("rank", F.rank().over(by_value)).where(F.col("rank") <= ranks)
    marking = marking.withColumn("split", F.col("block") < 0).join(names, ["id", "split"]).select(*GROUP, "item", "value")
    terms = marking.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= ranks)
    # a language that keeps no term still has its pairs, at no distance
    bare = groups.where(F.col("kept") == 0)
    zero = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where(F.col("source") != F.col("item"))
    pairs = _pair_sums(sums, groups).unionByName(zero.select(*GROUP, "item", F.lit(0).cast("long").alias("value")))
    pairs = pairs.withColumn("rank", F.row_number().over(by_item))
    columns = [*GROUP, "part", "item", "value", "rank"]
    both = pairs.withColumn("part", F.lit("pair")).select(columns)
    return both.unionByName(terms.withColumn("part", F.lit("term")).select(columns))


ORACLE_SQL = f"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as doc,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms from documents),
o as (select lang, source, doc, unnest(terms) as term from d),
c as (select lang, source, term, count(*) as n from o group by all),
k as (select lang, term, count(*) as n from o group by all having count(distinct doc) >= {LEAST_DOCUMENTS}),
l as (select lang, count(*) as v, sum(n) as total from k group by lang),
g as (select x.lang, x.source, coalesce(any_value(l.v), 0) as v, any_value(l.total) as total_lang, coalesce(sum(c.n) filter (k.term is not null), 0) as total
      from (select distinct lang, source from d) x left join l on x.lang = l.lang
      left join c on x.lang = c.lang and x.source = c.source left join k on c.lang = k.lang and c.term = k.term group by x.lang, x.source),
s as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
      1 + ({BILLION}::hugeint * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v)::hugeint as p,
      1 + ({BILLION}::hugeint * (k.n + 2)) // (g.total_lang + 2 * g.v)::hugeint as q
      from g join k on g.lang = k.lang left join c on g.lang = c.lang and g.source = c.source and k.term = c.term),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
      from s a join s b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
      union all select a.lang, a.source, b.source, 0 from g a join g b on a.lang = b.lang and a.source <> b.source where a.v = 0),
terms as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from s where n > 0 and p > q),
ranked as (select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
      union all select * from (select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) as rank
      from terms) where rank <= {RANKS})
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from ranked
"""
