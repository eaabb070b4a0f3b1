"""Small helpers for code that runs inside tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

import tidewell

ROWS_AT_ONCE = 512


def ship(spark: SparkSession) -> None:
    """Send the library to the executors, once per session; Spark serves the file."""
    context = spark.sparkContext
    if getattr(context, "_tidewell_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tidewell.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewell-"), "tidewell.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    archive.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    context.addPyFile(path)
    context._tidewell_shipped = True


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Record batches cut small, so that Python never holds many texts as objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


class Rows(dict):
    """Numbers words in the order they are met; ``fill`` computes what is kept of new ones.

    The table is emptied between documents once it holds ``most`` words, so its
    memory is bounded whatever the vocabulary.
    """

    def __init__(self, fill, most: int = 300_000):
        super().__init__()
        self.fill, self.most = fill, most
        self.new: list[str] = []
        self.kept: list[np.ndarray] = []
        self.size = 0

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def tables(self) -> list[np.ndarray]:
        """What ``fill`` returned, one array per quantity, a row per word."""
        if self.new:
            found = self.fill(self.new)
            have, need = self.size, self.size + len(self.new)
            if not self.kept or len(self.kept[0]) < need:
                room = max(1024, 2 * need)
                grown = [np.empty((room, *x.shape[1:]), x.dtype) for x in found]
                for to, old in zip(grown, self.kept):
                    to[:have] = old[:have]
                self.kept = grown
            for to, x in zip(self.kept, found):
                to[have:need] = x
            self.size, self.new = need, []
        return self.kept

    def rest(self) -> None:
        """Call between documents."""
        if len(self) > self.most:
            self.clear()
            self.new, self.kept, self.size = [], [], 0


def ngram_hashes(words: list[str], lengths: Iterable[int], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the byte n-grams of ``<word>`` and the word each one is from."""
    blob = "".join([f"\x02{w}\x03" for w in words]).encode("utf-8", "surrogatepass")
    data = np.frombuffer(blob, np.uint8)
    sizes = np.fromiter((len(w.encode("utf-8", "surrogatepass")) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    hashes, owners = [], []
    for n in lengths:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, 0x9E3779B97F4A7C15 ^ (seed + n), np.uint64)
        for k in range(n):
            code = (code ^ data[k : len(data) - n + 1 + k]) * np.uint64(0x100000001B3)
        whole = owner[: len(code)] == owner[n - 1 :]
        hashes.append(mixed(code[whole]))
        owners.append(owner[: len(code)][whole])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def mixed(code: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    code = code ^ (code >> np.uint64(33))
    code = code * np.uint64(0xFF51AFD7ED558CCD)
    code = code ^ (code >> np.uint64(33))
    code = code * np.uint64(0xC4CEB9FE1A85EC53)
    return code ^ (code >> np.uint64(33))


def grouped(texts: Iterable[str | None], split, most: int = 60_000) -> Iterator[list[list[str]]]:
    """Word lists of several documents at a time, about ``most`` words together."""
    group: list[list[str]] = []
    size = 0
    for text in texts:
        words = split(text or "")
        group.append(words)
        size += len(words)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of ``values`` (by its first axis); runs may be empty."""
    out = np.zeros((len(sizes), *values.shape[1:]))
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        out[some] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out
