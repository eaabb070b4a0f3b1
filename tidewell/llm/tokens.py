"""Token counts by a map-side two-tier lookup.

The tokenizer never joins text across a space that stands between two
non-space characters, so a text may be cut there and its pieces encoded apart.
Tier one is a table of frequent pieces and their lengths: every task counts its
pieces in bounded memory, only the head of each task's counts is added up, and
the heaviest pieces are encoded once and broadcast.  Tier two is a cache in each
worker, filled by encoding the pieces that the table lacks.  No piece of the
texts is shuffled.

Null texts count as empty; a repeated row gives a repeated result row; columns
besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.workers import slices

# A piece of the table has at most PIECE_CHARS characters, so the broadcast holds
# at most TABLE_PIECES * (4 * PIECE_CHARS + 2) bytes whatever the corpus.
TABLE_PIECES = 32_768
PIECE_CHARS = 32
COUNTED_PER_TASK = 200_000
HEAD_PER_TASK = 4_096
CACHED_PIECES = 300_000

# Characters some libraries call white space and others do not are never cut at.
_WIDE = r"[\s᠎​﻿]"
_ODD = re.compile(rf"{_WIDE}{_WIDE}|^{_WIDE}|{_WIDE}\Z")
_CUT = re.compile(rf"(?<!{_WIDE}) (?!{_WIDE})(?!\Z)(?<!^ )")


def cut(text: str) -> list[str]:
    """Pieces of a text; every piece but the first follows a space."""
    if _ODD.search(text) is None:
        return text.split(" ")
    return _CUT.split(text)


def byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies write for bytes: printable ones stand for
    themselves, the others for the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Encoder:
    """Ids of a text as the ``tokenizers`` library gives them for a vocabulary file.

    Pieces without special strings go through ``tiktoken`` over the ranks of the
    same file where that is possible, which is three times as fast; ``agrees``
    tells whether both give the same ids for some pieces.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in described.get("added_tokens", [])]
        self.ranks = self._ranks(described)
        self.checked = False

    @staticmethod
    def _ranks(described: dict):
        import public_tokenizers
        import tiktoken

        before = described.get("pre_tokenizer") or {}
        if described["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            return None
        if described.get("normalizer") or described["model"].get("ignore_merges"):
            return None
        added = {t["content"] for t in described.get("added_tokens", [])}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in word): n for word, n in described["model"]["vocab"].items() if word not in added}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.ranks is None or any(s in text for s in self.special):
            return self.library.encode(text, add_special_tokens=False).ids
        if not self.checked:
            # the two libraries must agree before the fast one is trusted
            self.checked = True
            probe = ["", "a", " the", " don't 12 __ ü\n\n x", " é中\U0001f600", text]
            if any(self.ranks.encode_ordinary(p) != self.library.encode(p, add_special_tokens=False).ids for p in probe):
                self.ranks = None
                return self.ids(text)
        return self.ranks.encode_ordinary(text)

    def agrees(self, pieces: list[str]) -> bool:
        slow = [e.ids for e in self.library.encode_batch(pieces, add_special_tokens=False)]
        return [self.ids(p) for p in pieces] == slow


class Cache(dict):
    """What is kept of each piece that follows a space; the second tier."""

    def __init__(self, path: str, keep, table: dict | None = None, most: int = CACHED_PIECES):
        super().__init__(table or {})
        self.encoder, self.keep, self.table, self.most = Encoder(path), keep, table or {}, most

    def __missing__(self, piece: str):
        kept = self[piece] = self.keep(self.encoder.ids(f" {piece}"))
        return kept

    def first(self, piece: str):
        return self.keep(self.encoder.ids(piece))

    def rest(self) -> None:
        """Call between documents: forgets all but the table once it is full."""
        if len(self) > self.most + len(self.table):
            self.clear()
            self.update(self.table)


def most_frequent(seen: Counter) -> Counter:
    """The pieces met more than once, at most COUNTED_PER_TASK // 2: as many new ones are met
    before this is called again, so a task's time follows its texts however long it is."""
    often = Counter({p: n for p, n in seen.items() if n > 1})
    most = COUNTED_PER_TASK // 2
    return often if len(often) <= most else Counter(dict(often.most_common(most)))


def frequent_pieces(docs: DataFrame, column: str = "text") -> DataFrame:
    """The heads of each task's piece counts, added up; bounded per task."""

    def count(batches):
        seen: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                seen.update(cut(text or "")[1:])
                if len(seen) > COUNTED_PER_TASK:
                    seen = most_frequent(seen)
        head = heapq.nlargest(HEAD_PER_TASK, ((n, p) for p, n in seen.items() if 0 < len(p) <= PIECE_CHARS))
        yield pa.record_batch([pa.array([p for _, p in head], pa.string()), pa.array([n for n, _ in head], pa.int64())], ["piece", "n"])

    heads = docs.select(F.col(column).cast("string").alias("text")).mapInArrow(count, "piece string, n long")
    return heads.groupBy("piece").agg(F.sum("n").alias("n"))


def length_table(docs: DataFrame, path: str, column: str = "text") -> dict[str, int]:
    """Frequent pieces and their lengths, encoded by the library itself."""
    rows = frequent_pieces(docs, column).orderBy(F.desc("n"), "piece").limit(TABLE_PIECES).collect()
    pieces = [r["piece"] for r in rows]
    encoder = Encoder(path)
    encoded = encoder.library.encode_batch([f" {p}" for p in pieces], add_special_tokens=False)
    return {p: len(e.ids) for p, e in zip(pieces, encoded)}


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(length_table(docs, path))

    def count(batches):
        cache = Cache(path, len, table.value)
        for batch in slices(batches):
            totals = []
            for text in batch.column(1).to_pylist():
                first, *rest = cut(text or "")
                totals.append(cache.first(first) + sum(map(cache.__getitem__, rest)))
                cache.rest()
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            n_tokens = pa.array(totals, pa.int64())
            yield pa.record_batch([batch.column(0), n_bytes, n_tokens, pc.greater(n_tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
