"""Alignment of two tokenizers over a corpus, counted in inverted pair bitmaps.

A text with a space before it is cut into tokens by a byte-level vocabulary (A) and by a
piece vocabulary (B).  Both cover the same bytes; every occurrence of an A token whose
bytes overlap those of a B token is a link, and bytes where tokens of both end cut the
tokens into groups.

Rows of the corpus are numbered within containers of at most 65,536 rows.  The index has,
per container and pair of ids, bitmaps of the rows that hold the pair: row ``r`` is in
plane ``k`` if bit ``k`` of its number of such links is set.  The OR of the planes,
popcounted, says how many documents hold a pair, the weighted popcounts of the planes how
many links.  The counts are added over all containers, and the postings carry the scores
back: every bit of a plane gives its row the weight of the plane times the pair's score.

A container is closed before its postings fill a task's memory, so neither a frequent
pair nor a long partition gathers in one place; a pair has one index row per container,
which Spark may split between tasks.

Neither vocabulary joins text across a space between two other characters (for B this is
read off its pieces), so texts are cut there and each distinct piece is aligned once per
worker.  Null and empty texts, and texts that either vocabulary doesn't give back byte by
byte, have no tokens: zeros, and '' for the hash.  Repeated rows and null ids are
documents of their own; columns besides ``doc_id`` and ``text`` are not read.  An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.bitmaps import NUMBERS, document_counts, multiplicity_planes, read_planes
from tidewell.llm.tokens import Encoder, byte_letters, cut
from tidewell.llm.workers import slices
from tidewell.session import settle

# A container is closed at this many postings (24 bytes each while it is open).
POSTINGS = 2_000_000
WORDS_AT_ONCE = 120_000
# Aligned pieces a worker keeps, and their bytes.
CACHED_PIECES = 200_000
CACHED_BYTES = 16_000_000


def spelled(ids: np.ndarray, table: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of a table's entries one after another."""
    long = sizes[ids]
    place = np.arange(long.sum()) + np.repeat(starts[ids] - (np.cumsum(long) - long), long)
    return table[place]


class Spelling:
    """A table of byte strings, laid out for ``spelled``."""

    def __init__(self, strings: list[bytes]):
        self.table = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def of(self, ids: np.ndarray) -> np.ndarray:
        return spelled(ids, self.table, self.starts, self.sizes)


class ByteVocabulary:
    """A byte-level vocabulary of the ``tokenizers`` library; special strings are plain text.

    The rank encoder of ``tokens`` over the same file does the work as long as it agrees
    with the library on samples of the pieces met: all of the first call, and every 64th.
    """

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.library = self.encoder.library
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters = byte_letters()
        self.bytes = [b""] * (max(self.library.get_vocab().values()) + 1)
        for word, number in described["model"]["vocab"].items():
            self.bytes[number] = bytes(letters.get(c, 32) for c in word)
        self.every = 1

    def encode(self, pieces: list[str]) -> list[list[int]]:
        pieces = [f" {p}" for p in pieces]
        if self.encoder.ranks is not None:
            found = list(map(self.encoder.ranks.encode_ordinary, pieces))
            if found[:: self.every] == self.by_library(pieces[:: self.every]):
                self.every = 64
                return found
            self.encoder.ranks = None
        return self.by_library(pieces)

    def by_library(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(pieces, add_special_tokens=False)]


class PieceVocabulary:
    """A vocabulary of the ``sentencepiece`` library, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(n) for n in range(self.library.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)
        ]
        # a piece with a space behind another character would join what ``cut`` parts
        self.parts_at_spaces = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return self.library.encode(pieces, num_threads=1)


class Aligned(dict):
    """Numbers pieces of text in the order they are met and aligns each once."""

    def __init__(self, path_a: str, path_b: str):
        super().__init__()
        self.a, self.b = ByteVocabulary(path_a), PieceVocabulary(path_b)
        self.spelling = [Spelling(v.bytes) for v in (self.a, self.b)]
        # every id in decimal digits, behind them one byte for what follows it
        most = max(len(self.a.bytes), len(self.b.bytes))
        self.digits = Spelling([b"%d " % n for n in range(most)])
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.sizes = np.empty((0, 4), np.int64)
        self.fails = np.empty(0, bool)
        self.codes = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.strings: list[bytes] = []
        self.characters = 0

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number

    def cut(self, text: str) -> list[str]:
        return cut(text) if self.b.parts_at_spaces else [text]

    def fill(self) -> None:
        """Align the pieces met since the last call."""
        if not self.new:
            return
        wholes = [f" {p}".encode("utf-8", "surrogatepass") for p in self.new]
        whole = np.frombuffer(b"".join(wholes), np.uint8)
        ends_of = np.cumsum([len(w) for w in wholes])
        fails = np.zeros(len(wholes), bool)
        tokens = []
        for vocabulary, spelling in zip((self.a, self.b), self.spelling):
            ids = vocabulary.encode(self.new)
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int64, counts.sum())
            fails |= self._unlike(flat, counts, spelling, whole, ends_of)
            tokens.append((flat, counts))
        # the pieces that both give back, one after another, are one run of bytes
        (flat_a, counts_a), (flat_b, counts_b) = ((f[~np.repeat(fails, c)], np.where(fails, 0, c)) for f, c in tokens)
        ends_a, ends_b = (np.cumsum(spelling.sizes[f]) for spelling, f in zip(self.spelling, (flat_a, flat_b)))
        piece_ends = np.concatenate([[0], ends_a])[np.cumsum(counts_a)]
        # every place where a token ends, and where tokens of both end
        marks = np.zeros(int(piece_ends[-1]) + 1, np.int8)
        marks[ends_a] += 1
        marks[ends_b] += 1
        ends, both = np.flatnonzero(marks), np.flatnonzero(marks == 2)
        after_a, after_b = (np.cumsum(marks_of) for marks_of in (self._ends(marks, ends_a), self._ends(marks, ends_b)))
        codes = flat_a[after_a[ends - 1]] * len(self.b.bytes) + flat_b[after_b[ends - 1]]
        upto = np.cumsum(marks > 0)[piece_ends]
        links = np.diff(upto, prepend=0)
        upto = np.cumsum(marks == 2)[piece_ends]
        groups = np.diff(upto, prepend=0)
        self.strings += self._written(flat_a, flat_b, after_a[both], after_b[both], upto)
        self.starts = np.concatenate([self.starts, len(self.codes) + np.cumsum(links) - links])
        self.codes = np.concatenate([self.codes, codes])
        self.sizes = np.concatenate([self.sizes, np.stack([counts_a, counts_b, groups, links], 1)])
        self.fails = np.concatenate([self.fails, fails])
        self.characters += sum(map(len, self.new))
        self.new = []

    @staticmethod
    def _ends(marks: np.ndarray, ends: np.ndarray) -> np.ndarray:
        own = np.zeros(len(marks), np.int64)
        own[ends] = 1
        return own

    @staticmethod
    def _unlike(flat: np.ndarray, counts: np.ndarray, spelling: Spelling, whole: np.ndarray, ends_of: np.ndarray) -> np.ndarray:
        """Which pieces' tokens do not spell their bytes."""
        ends = np.concatenate([[0], np.cumsum(spelling.sizes[flat])])[np.cumsum(counts)]
        long = np.diff(ends, prepend=0)
        wanted = np.diff(ends_of, prepend=0)
        fails = long != wanted
        said = spelling.of(flat)[~np.repeat(fails, long)]
        same = said == whole[~np.repeat(fails, wanted)]
        if not same.all():
            owner = np.repeat(np.flatnonzero(~fails), wanted[~fails])
            fails[owner[~same]] = True
        return fails

    def _written(self, flat_a: np.ndarray, flat_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, upto: np.ndarray) -> list[bytes]:
        """The groups of every piece: ids of A, a bar, ids of B; semicolons between groups."""
        sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        before = np.cumsum(sizes_a + sizes_b) - sizes_a - sizes_b
        ids = np.empty(len(flat_a) + len(flat_b), np.int64)
        place_a = np.arange(len(flat_a)) + np.repeat(before - (cuts_a - sizes_a), sizes_a)
        place_b = np.arange(len(flat_b)) + np.repeat(before + sizes_a - (cuts_b - sizes_b), sizes_b)
        ids[place_a], ids[place_b] = flat_a, flat_b
        text = self.digits.of(ids)
        last = np.cumsum(self.digits.sizes[ids])
        text[last - 1] = ord(",")
        text[last[before + sizes_a - 1] - 1] = ord("|")
        closing = last[before + sizes_a + sizes_b - 1]
        text[closing - 1] = ord(";")
        ends = np.concatenate([[0], closing])[upto].tolist()
        joined = text.tobytes()
        # without the semicolon behind the last group
        return [joined[begin : max(begin, end - 1)] for begin, end in zip([0, *ends], ends)]

    def rest(self) -> None:
        """Call between groups of documents."""
        if len(self) > CACHED_PIECES or self.characters > CACHED_BYTES:
            self.empty()

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Sizes and hash of each text, and the text and code of every link."""
        pieces = [self.cut(t) if t else [] for t in texts]
        numbers = [np.fromiter(map(self.__getitem__, p), np.int64, len(p)) for p in pieces]
        self.fill()
        numbers = [n if not self.fails[n].any() else n[:0] for n in numbers]
        hashes = [
            hashlib.sha256(b";".join(map(self.strings.__getitem__, n.tolist()))).hexdigest() if len(n) else "" for n in numbers
        ]
        flat = np.concatenate([np.empty(0, np.int64), *numbers])
        owner = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
        sizes = np.zeros((len(texts), 4), np.int64)
        np.add.at(sizes, owner, self.sizes[flat])
        links = self.sizes[flat, 3]
        place = np.arange(links.sum()) + np.repeat(self.starts[flat] - (np.cumsum(links) - links), links)
        return sizes, hashes, np.repeat(owner, links), self.codes[place]


def index(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of the corpus (``row`` set) and postings (``a``, ``b``, ``planes`` set) of every container."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    schema = f"container long, row int, doc_id {kind}, {', '.join(f'{n} long' for n in numbers)}, groups_sha256 string, a int, b int, planes array<binary>"
    planes_type = pa.list_(pa.binary())

    def work(batches):
        aligned = Aligned(path_a, path_b)
        container, rows, held, open_keys, open_counts = TaskContext.get().partitionId() << 32, 0, 0, [], []

        def described(ids, first, sizes, hashes):
            n = len(ids)
            columns = [pa.array(np.full(n, container)), pa.array(np.arange(first, first + n), pa.int32()), ids]
            columns += [pa.array(sizes[:, k]) for k in range(4)]
            columns += [pa.array(hashes, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, planes_type)]
            return pa.record_batch(columns, NAMES)

        def closed():
            keys, counts = np.concatenate(open_keys), np.concatenate(open_counts)
            order = np.argsort(keys)
            codes, planes = multiplicity_planes(keys[order], counts[order])
            n, b = len(codes), len(aligned.b.bytes)
            columns = [pa.array(np.full(n, container)), pa.nulls(n, pa.int32()), pa.nulls(n, id_type)]
            columns += [pa.nulls(n, pa.int64())] * 4 + [pa.nulls(n, pa.string())]
            columns += [pa.array(codes // b, pa.int32()), pa.array(codes % b, pa.int32()), planes]
            return pa.record_batch(columns, NAMES)

        for batch in slices(batches):
            id_type = batch.schema.field(0).type
            texts = batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and size < WORDS_AT_ONCE:
                    size += len(texts[end] or "") // 4 + 1
                    end += 1
                end = min(end, begin + NUMBERS - rows)
                sizes, hashes, owner, codes = aligned.documents(texts[begin:end])
                yield described(batch.column(0).slice(begin, end - begin), rows, sizes, hashes)
                keys, counts = np.unique(codes << 16 | (owner + rows), return_counts=True)
                open_keys.append(keys)
                open_counts.append(counts)
                aligned.rest()
                rows, held, begin = rows + end - begin, held + len(keys), end
                if rows == NUMBERS or held >= POSTINGS:
                    yield closed()
                    container, rows, held, open_keys, open_counts = container + 1, 0, 0, [], []
        if rows:
            yield closed()

    NAMES = ["container", "row", "doc_id", *numbers, "groups_sha256", "a", "b", "planes"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(work, schema)


def pair_counts(postings: DataFrame) -> DataFrame:
    """a, b, documents, links of every pair, and whether its links are the most of its ``b``."""

    def popcounts(batches):
        for batch in batches:
            documents, links = document_counts(batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(documents, pa.int64()), pa.array(links)], ["a", "b", "documents", "links"])

    counts = postings.select("a", "b", "planes").mapInArrow(popcounts, "a int, b int, documents long, links long")
    counts = counts.groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    # a B id has at most as many partners as vocabulary A has entries
    return counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def returned(postings: DataFrame, scores: DataFrame) -> DataFrame:
    """container, row, n_best, count_sum: what the postings carry back to the rows."""

    def carry(batches):
        at, totals = None, np.zeros((2, NUMBERS), np.int64)

        def sums():
            rows = np.flatnonzero(totals[1])
            columns = [pa.array(np.full(len(rows), at, np.int64)), pa.array(rows, pa.int32()), pa.array(totals[0][rows]), pa.array(totals[1][rows])]
            return pa.record_batch(columns, ["container", "row", "n_best", "count_sum"])

        for batch in batches:
            containers = batch.column(0).to_numpy()
            borders = np.flatnonzero(np.diff(containers)) + 1
            for begin, end in zip([0, *borders.tolist()], [*borders.tolist(), len(containers)]):
                if begin == end:
                    continue
                if at is not None and at != containers[begin]:
                    yield sums()
                    totals[:] = 0
                at = containers[begin]
                links, best = (batch.column(n).slice(begin, end - begin).to_numpy(zero_copy_only=False) for n in (1, 2))
                rows, members, weights = read_planes(batch.column(3).slice(begin, end - begin))
                np.add.at(totals[0], members, weights * best[rows])
                np.add.at(totals[1], members, weights * links[rows])
        if at is not None:
            yield sums()

    scored = postings.join(scores, ["a", "b"]).select("container", "links", "best", "planes")
    sorted_rows = scored.repartition("container").sortWithinPartitions("container")
    return sorted_rows.mapInArrow(carry, "container long, row int, n_best long, count_sum long")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    found = settle(index(docs, path_a, path_b), "pair-index")
    rows = found.where(F.col("row").isNotNull()).drop("a", "b", "planes")
    postings = found.where(F.col("a").isNotNull()).select("container", "a", "b", "planes")
    sums = returned(postings, pair_counts(postings))
    none = [F.coalesce(n, F.lit(0)).alias(n) for n in ("n_best", "count_sum")]
    return rows.join(sums, ["container", "row"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *none, "groups_sha256")
