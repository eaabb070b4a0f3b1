"""Quality classifier: supervised subword embeddings.

A document is the mean of the learned vectors of its words, adjacent word pairs
and character n-grams, all hashed into one table; a softmax layer reads the mean.
The vectors are trained by stochastic gradient descent in numpy on a bounded
sample: ``PER_CLASS`` labelled documents of each class, the lowest by a hash of
their id.  The output is moved from the sample's class balance to the balance of
all labels.  As the layer is linear, scoring needs one number per table row, so a
word's share is computed once per worker and looked up after that.

A pair of equal words is one feature whatever the word, so that repetition shows.
Words are split at white space.  Null and empty texts have no features and get the
score of the class balance.  Without labels the score is 0.5; with labels of one
class only, the smoothed balance.  Conflicting labels of a document count as the
lower one; repeated rows are scored each.  Only doc_id and text are read, so other
columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.splits import held_out
from tidewell.llm.workers import Rows, grouped, mixed, ngram_hashes, slices, sums

PER_CLASS = 2_500
BUCKETS = 1 << 18
WIDTH = 8
CHARACTERS = (3, 4)
EPOCHS = 6
RATE = 8.0
_SAME = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """Hash of each word and the next one."""
    left, right = hashes[:-1], hashes[1:]
    return np.where(left == right, _SAME, mixed(left * _PAIR + right))


def features(words: list[str]) -> np.ndarray:
    """Table rows of a document's features, repeats included."""
    if not words:
        return np.empty(0, np.int64)
    whole = _word_hashes(words)
    parts, _ = ngram_hashes(words, CHARACTERS)
    return _bucket(np.concatenate([whole, parts, _pairs(whole)]))


@dataclass(frozen=True)
class QualityModel:
    """``weights[f]`` is what feature f adds to the log odds of class 1, ``bias`` the rest."""

    weights: np.ndarray
    bias: float

    def scorer(self):
        weights = self.weights

        def fill(words: list[str]):
            whole = _word_hashes(words)
            parts, owner = ngram_hashes(words, CHARACTERS)
            value = weights[_bucket(whole)] + np.bincount(owner, weights[_bucket(parts)], len(words))
            return value, 1 + np.bincount(owner, minlength=len(words)), whole

        rows = Rows(fill)

        def score(texts: list[str | None]) -> np.ndarray:
            out = []
            for group in grouped(texts, str.split):
                sizes = np.array([len(words) for words in group])
                numbers = rows.numbers(list(chain.from_iterable(group)))
                value, count, whole = (t[numbers] for t in rows.tables() or [np.zeros(0), np.zeros(0), np.zeros(0, np.uint64)])
                if len(numbers):
                    # pairs across documents are taken out
                    value[:-1] += np.where(np.delete(np.repeat(np.arange(len(group)), sizes), 0) == np.repeat(np.arange(len(group)), sizes)[:-1], weights[_bucket(_pairs(whole))], 0.0)
                total, features = sums(value, sizes), sums(count, sizes) + np.maximum(sizes - 1, 0)
                out.append(total / np.maximum(features, 1))
                rows.rest()
            z = np.concatenate(out) + self.bias if out else np.empty(0)
            return 1 / (1 + np.exp(-np.clip(z, -700, 700)))

        return score


def train(texts: list[str], labels: list[int], balance: float, seed: int = 7) -> QualityModel:
    """Gradient descent on documents of both classes; ``balance`` is the log odds of all labels."""
    docs = []
    for text in texts:
        rows, counts = np.unique(features((text or "").split()), return_counts=True)
        docs.append((rows.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    # the two softmax rows only matter by their difference
    output, bias = random.uniform(-1, 1, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for n in random.permutation(len(docs)):
            rows, share = docs[n]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = share @ vectors[rows]
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[n]] -= 1
            back = output @ error
            output -= 0.05 * rate * np.outer(hidden, error)
            bias -= 0.002 * rate * error
            # as the shares are small, each vector is moved by its share of the largest
            vectors[rows] -= rate * np.outer(share / max(1e-9, float(np.sqrt(share @ share))), back) * 0.05
    difference = (output[:, 1] - output[:, 0]).astype(np.float64)
    sampled = np.bincount(labels, minlength=2)
    shift = balance - float(np.log(sampled[1] / sampled[0]))
    return QualityModel(vectors.astype(np.float64) @ difference, float(bias[1] - bias[0]) + shift)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    """Learn from the labelled rows that are not held out, ``per_class`` of each at most."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    balance = float(np.log((ones + 1) / (zeros + 1)))
    flat = QualityModel(np.zeros(BUCKETS), balance)
    if not ones or not zeros:
        return flat
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = usable.where("quality = 0").orderBy(*order).limit(per_class)
    chosen = chosen.unionAll(usable.where("quality = 1").orderBy(*order).limit(per_class))
    # at most 2 * per_class rows of two numbers, whatever the input
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # a repeated id gives one training document
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    rows = sample.orderBy("doc_id").toPandas()
    if rows["quality"].nunique() < 2:
        return flat
    return train(rows["text"].tolist(), rows["quality"].astype(int).tolist(), balance)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = shared.value.scorer()
        for batch in slices(batches):
            p = scorer(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """The rows, all columns, whose score is at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        scorer = shared.value.scorer()
        for batch in slices(batches):
            yield batch.filter(pa.array(scorer(batch.column(at).cast(pa.string()).to_pylist()) >= threshold))

    return docs.mapInArrow(run, docs.schema)
