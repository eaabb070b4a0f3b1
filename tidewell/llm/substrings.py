"""Removal of word sequences that repeat across documents, by FM-indexes over shards.

A window is ``WINDOW`` consecutive words.  A word goes if a window over it also starts
in a document with a smaller id.  The work is led to small shards in steps:

1. Documents with equal words form a class.  All but the smallest id of a class
   consist of repeated windows; only that one goes on.
2. Every window has an anchor: the least hash of its runs of ``ANCHOR`` words.  Equal
   windows have equal anchors, and a document's windows fall into runs of one anchor.
   Anchors that only one class has are done; for the others the class's words are
   fetched and each run becomes a passage, routed by its anchor.  An anchor with more
   than ``PASSAGES`` passages is split: each of its windows is a passage, routed by its
   own hash, and equal windows of a task are sent once.  Equal passages of one document are
   one row with all their places, so that a line that it repeats is answered once.
3. Equal passages are joined into one with the smallest id.  Each shard of passages
   builds a compressed FM-index, and streams its passages through it: backward search
   gives the windows that occur and the smallest id they occur under.
4. Windows that occur under a smaller id go back to the documents.

Texts are only shuffled for classes with shared anchors; a bit table of fixed size
keeps the others back.  Words are compared by 64-bit hashes.

Null texts have no words.  Documents of fewer words than a window keep them all.
Rows that repeat an id and a text are alike, and rows of one id do not cut each
other; rows with a null id are left as they are and cut nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.fmindex import FMIndex
from tidewell.llm.neardup import WordHashes
from tidewell.llm.sieve import only
from tidewell.llm.workers import mixed, slices
from tidewell.session import settle

WINDOW = 50
ANCHOR = 25
PASSAGES = 4_000
RUN = 64
SHARD_WORDS = 100_000
_EMPTY = hashlib.sha256(b"").hexdigest()
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Rolling:
    """Hashes of all runs of some length, whatever their place."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def hashes(self, words: np.ndarray, length: int) -> np.ndarray:
        n = len(words) - length + 1
        if n < 1:
            return np.empty(0, np.uint64)
        if len(self.up) < len(words):
            size = 2 * len(words)
            self.up = np.cumprod(np.full(size, _BASE), dtype=np.uint64)
            self.down = np.cumprod(np.full(size, _INVERSE), dtype=np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[: len(words)], dtype=np.uint64)])
        return mixed((total[length:] - total[:n]) * self.down[:n])


def anchors(words: np.ndarray, rolling: Rolling) -> np.ndarray:
    """Anchor of every window: the least hash of its runs of ANCHOR words."""
    least = rolling.hashes(words, ANCHOR)
    span, have = WINDOW - ANCHOR + 1, 1
    if len(least) < span:
        return np.empty(0, np.uint64)
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def runs(anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of windows with one anchor, RUN at most."""
    if not len(anchor):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    lengths = np.diff(np.append(starts, len(anchor)))
    pieces = -(-lengths // RUN)
    first = np.repeat(starts, pieces)
    number = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = first + RUN * number
    end = np.minimum(start + RUN, np.repeat(starts + lengths, pieces))
    return start, end - start


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _class(words: np.ndarray) -> int:
    """Signed 64-bit key of a class."""
    return int(np.array(xxhash.xxh3_64_intdigest(words.tobytes()), np.uint64).astype(np.int64))


def _surveyed(docs: DataFrame) -> DataFrame:
    """One row per document (n_words, digest, kept_sha256, class) and one per run (class, anchor)."""

    def run(batches):
        hashes, rolling = WordHashes(), Rolling()
        names = ["doc_id", "n_words", "digest", "kept_sha256", "class", "anchor", "start", "windows"]
        kinds = [None, pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        for batch in slices(batches):
            kinds[0] = batch.schema.field(0).type
            rows: list[tuple] = []
            parts: list[list[np.ndarray]] = [[], [], [], []]
            owners: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _words(text)
                codes = hashes.of(words)
                key = _class(codes)
                rows.append((doc, len(words), xxhash.xxh128_digest(codes.tobytes()), hashlib.sha256(b" ".join(words)).hexdigest(), key))
                anchor = anchors(codes, rolling)
                if len(anchor) and doc is not None:
                    start, length = runs(anchor)
                    for part, values in zip(parts, (np.full(len(start), key, np.int64), anchor[start].view(np.int64), start, length)):
                        part.append(values)
                    owners.append((doc, len(start)))
            columns = list(zip(*rows))
            yield pa.record_batch([*[pa.array(list(c), k) for c, k in zip(columns, kinds)], *[pa.nulls(len(rows), k) for k in kinds[5:]]], names)
            if owners:
                n = sum(size for _, size in owners)
                key, anchor, start, length = (np.concatenate(p) for p in parts)
                doc = pa.array([d for d, _ in owners], kinds[0]).take(pa.array(np.repeat(np.arange(len(owners)), [s for _, s in owners])))
                yield pa.record_batch([doc, *[pa.nulls(n, k) for k in kinds[1:4]], pa.array(key), pa.array(anchor), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, digest binary, kept_sha256 string, class long, anchor long, start int, windows int"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def _passages(texts: DataFrame, kind: str) -> DataFrame:
    """Distinct passages of each of texts(doc_id, text, class, runs): their route, hash and
    places, and their words once per task."""

    def run(batches):
        hashes, rolling = WordHashes(), Rolling()
        sent: set[bytes] = set()
        names = ["route", "digest", "doc_id", "class", "starts", "words"]
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc, text, key, found in zip(*(batch.column(k).to_pylist() for k in range(4))):
                codes = hashes.of(_words(text))
                if _class(codes) != key:
                    continue  # another text under the same id
                places: dict[tuple[int, bytes], list[int]] = {}
                bodies: dict[bytes, bytes] = {}
                for part in found:
                    start, windows = part["start"], part["windows"]
                    pieces = [(part["anchor"], start, windows)]
                    if part["hot"]:
                        whole = rolling.hashes(codes[start : start + windows + WINDOW - 1], WINDOW).view(np.int64)
                        pieces = [(int(whole[k]), start + k, 1) for k in range(windows)]
                    for route, at, n in pieces:
                        words = codes[at : at + n + WINDOW - 1].tobytes()
                        digest = xxhash.xxh128_digest(words)
                        places.setdefault((route, digest), []).append(at)
                        bodies[digest] = words
                for (route, digest), starts in places.items():
                    for column, value in zip(out, (route, digest, doc, key, sorted(starts), None if digest in sent else bodies[digest])):
                        column.append(value)
                    sent.add(digest)
                    if len(sent) > 200_000:
                        sent.clear()
            kinds = [pa.int64(), pa.binary(), batch.schema.field(0).type, pa.int64(), pa.list_(pa.int32()), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names)

    schema = f"route long, digest binary, doc_id {kind}, class long, starts array<int>, words binary"
    return texts.select("doc_id", "text", "class", "runs").mapInArrow(run, schema)


def _searched(passages: DataFrame) -> DataFrame:
    """route, digest and, for each window of a passage, the smallest id it occurs under."""

    def search(shard: pa.Table) -> pa.Table:
        sequences = [np.frombuffer(w, np.uint64) for w in shard.column("words").to_pylist()]
        least = shard.column("least").combine_chunks().cast(pa.int64()).to_numpy()
        index = FMIndex(sequences, least, WINDOW)
        found = index.least_values(sequences, np.iinfo(np.int64).max)
        return pa.table([shard.column("route"), shard.column("digest"), pa.array(found, pa.list_(pa.int64()))], ["route", "digest", "found"])

    return passages.groupBy("shard").applyInArrow(search, "route long, digest binary, found array<long>")


def _cut(texts: DataFrame, kind: str) -> DataFrame:
    """doc_id, class, n_removed, sha of what is kept, for texts(doc_id, text, class, starts)."""

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            for doc, text, key, starts in zip(*(batch.column(k).to_pylist() for k in range(4))):
                words = _words(text)
                if _class(hashes.of(words)) != key:
                    continue
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, np.asarray(starts) + WINDOW, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = b" ".join([w for w, g in zip(words, gone) if not g])
                for column, value in zip(out, (doc, key, int(gone.sum()), hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["cut_id", "cut_class", "removed", "sha"])

    rows = texts.select("doc_id", "text", "class", "starts").mapInArrow(run, f"cut_id {kind}, cut_class long, removed long, sha string")
    return rows.dropDuplicates(["cut_id", "cut_class"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id, class, start: every window of a class's smallest id that also starts under a smaller id."""
    return _repeated(docs, settle(_surveyed(docs), "surveyed"))[0]


def _repeated(docs: DataFrame, surveyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    kind = docs.schema["doc_id"].dataType.simpleString()
    members = surveyed.where(F.col("n_words").isNotNull())
    classes = members.where(F.col("doc_id").isNotNull()).groupBy("digest", "class").agg(F.min("doc_id").alias("least"))
    classes = settle(classes, "classes")
    found = surveyed.where(F.col("anchor").isNotNull()).select("anchor", "class", "doc_id", "start", "windows")
    shared = found.groupBy("anchor").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    shared = settle(shared.select("anchor"), "shared")
    first = classes.select(F.col("least").alias("doc_id"), "class").distinct()
    candidates = found.join(shared, "anchor", "left_semi").select("doc_id", "class", "anchor", "start", "windows")
    candidates = settle(candidates.join(first, ["doc_id", "class"], "left_semi").distinct(), "candidates")
    crowded = settle(candidates.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > PASSAGES).select("anchor", F.lit(True).alias("hot")), "crowded")
    spread = candidates.join(crowded, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    by_text = spread.groupBy("doc_id", "class").agg(F.collect_list(F.struct("anchor", "start", "windows", "hot")).alias("runs"))
    by_text = settle(by_text, "runs")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    passages = settle(_passages(only(texts, by_text).join(by_text, "doc_id"), kind), "passages")
    distinct = passages.groupBy("route", "digest").agg(F.min("doc_id").alias("least"), F.max("words").alias("words"))
    distinct = settle(distinct, "distinct")
    size = distinct.agg(F.sum(F.length("words")) / 8).first()[0] or 0
    shards = max(1, int(size // SHARD_WORDS))
    sharded = distinct.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    answers = settle(_searched(sharded), "answers")
    places = passages.select("route", "digest", "doc_id", "class", "starts").distinct()
    windows = places.join(answers, ["route", "digest"]).select("doc_id", "class", "starts", F.posexplode("found").alias("k", "under"))
    windows = windows.where(F.col("under") < F.col("doc_id")).select("doc_id", "class", "k", F.explode("starts").alias("start"))
    windows = windows.select("doc_id", "class", (F.col("start") + F.col("k")).alias("start"))
    return windows, classes


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs(doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    surveyed = settle(_surveyed(docs), "surveyed")
    windows, classes = _repeated(docs, surveyed)
    marked = settle(windows.groupBy("doc_id", "class").agg(F.collect_set("start").alias("starts")), "marked")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    cut = settle(_cut(only(texts, marked).join(marked, "doc_id"), kind), "cut")
    members = surveyed.where(F.col("n_words").isNotNull()).select("doc_id", "n_words", "digest", "kept_sha256", "class")
    members = members.join(classes.select("digest", "least"), "digest", "left")
    members = members.join(cut, (F.col("doc_id") == F.col("cut_id")) & (F.col("class") == F.col("cut_class")), "left")
    copy = (F.col("doc_id") > F.col("least")) & (F.col("n_words") >= WINDOW)
    removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0)))
    kept = F.when(copy, F.lit(_EMPTY)).otherwise(F.coalesce("sha", "kept_sha256"))
    return members.select("doc_id", "n_words", removed.cast("long").alias("n_removed"), kept.alias("kept_sha256"))
