import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import awkward, bag, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewell.llm import packing, queries, tokens

LIBRARY = Tokenizer.from_file(queries.vocabulary())


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


TEXTS = st.text(st.sampled_from(list("ab 1 .,'\n\t é中  ​\x1c  <|endoftext|>")) | st.characters(exclude_categories=["Cs"]), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXTS | st.lists(st.sampled_from(["a", " ", "  ", "<|endoftext|>", "\n", "don't", " 12", "é"])).map("".join))
def test_pieces_encode_as_the_whole_text(text):
    first, *rest = tokens.cut(text)
    cache = test_pieces_encode_as_the_whole_text.__dict__.setdefault("cache", tokens.Cache(queries.vocabulary(), list))
    assert cache.first(first) + [i for piece in rest for i in cache[piece]] == ids(text)


def test_both_encoders_agree_on_the_vocabulary():
    random.seed(2)
    some = random.sample(sorted(LIBRARY.get_vocab()), 2000)
    assert tokens.Encoder(queries.vocabulary()).agrees(some)


def test_counts(spark):
    want = [(r[0], len((r[1] or "").encode()), len(ids(r[1])), len(ids(r[1])) > 512) for r in awkward()]
    assert bag(tokens.count_tokens(documents(spark), queries.vocabulary()).collect()) == bag(want)
    assert tokens.count_tokens(documents(spark, []), queries.vocabulary()).count() == 0


def test_a_full_cache_is_emptied():
    cache = tokens.Cache(queries.vocabulary(), len, {"the": 1}, most=2)
    assert [cache[p] for p in ("aq", "bq", "cq", "dq")]
    cache.rest()
    assert dict(cache) == {"the": 1}


def test_a_long_task_does_not_cut_its_counts_for_every_text(monkeypatch):
    """As many new pieces come between two cuts as a cut leaves, even where every piece is repeated."""
    made = []

    class Counted(Counter):
        def __init__(self, *given):
            made.append(len(given[0]) if given else 0)
            super().__init__(*given)

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.run = run
            return self

        groupBy = agg = select

    monkeypatch.setattr(tokens, "Counter", Counted)
    monkeypatch.setattr(tokens, "COUNTED_PER_TASK", 100)
    docs = Docs()
    monkeypatch.setattr(tokens.F, "col", lambda _: Docs())
    monkeypatch.setattr(Docs, "cast", lambda self, _: self, raising=False)
    monkeypatch.setattr(Docs, "alias", lambda self, _: self, raising=False)
    monkeypatch.setattr(tokens.F, "sum", lambda _: Docs())
    tokens.frequent_pieces(docs)
    often = ["x", *["often"] * 5]
    texts = [" ".join([*often, *[f"p{k}" for k in range(150) for _ in range(2)]])] + [" ".join([*often, f"q{k}", f"q{k}"]) for k in range(300)]
    (head,) = docs.run([pa.record_batch([pa.array(texts)], ["text"])])
    found = dict(zip(head.column(0).to_pylist(), head.column(1).to_pylist()))
    assert found["often"] == 5 * len(texts) and len(found) <= 100
    assert len(made) < 30


def smallest(lengths, size):
    """Fewest sequences, by trying everything."""
    best = [len(lengths)]

    def place(k, free):
        if len(free) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(free)
            return
        for j in {f: j for j, f in enumerate(free)}.values():
            if free[j] >= lengths[k]:
                place(k + 1, [*free[:j], free[j] - lengths[k], *free[j + 1 :]])
        place(k + 1, [*free, size - lengths[k]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_is_below_and_fit_above_the_optimum(lengths):
    placed = packing.best_fit(sorted(lengths, reverse=True), 20)
    filled = np.bincount(placed, sorted(lengths, reverse=True))
    assert filled.max() <= 20
    assert packing.lower_bound(np.array(lengths), 20) <= smallest(lengths, 20) <= len(filled)


def test_bound_sees_more_than_the_sum():
    assert packing.lower_bound(np.array([11] * 6), 20) == 6
    assert packing.lower_bound(np.array([7] * 6), 20) == 3


@pytest.mark.parametrize("group", [8, 2048])
def test_packing(spark, monkeypatch, group):
    docs = documents(spark)
    items = packing.pieces(docs, queries.vocabulary(), 256)
    rows = packing.pack(packing.settle(items, "t"), 256, group).collect()
    check(rows, awkward(), 256)


def check(rows, docs, size):
    want = []
    for r in docs:
        whole = [*ids(r[1]), 0]
        start, length, piece = 0, len(whole) % size or size, 0
        while start < len(whole):
            part = np.array(whole[start : start + length], "<u4").tobytes()
            want.append((r[0], piece, start, length, zlib.crc32(part)))
            start, length, piece = start + length, size, piece + 1
    assert bag(tuple(r)[:5] for r in rows) == bag(want)
    laid = {}
    for r in rows:
        laid.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in laid.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    total = sum(r["length"] for r in rows)
    assert len(laid) <= -(-total // size) + 6


def test_groups_with_gaps_exchange(spark):
    random.seed(4)
    lengths = [random.choice([700, 900, 1100, 1300, 40, 90]) for _ in range(600)]
    rows = [(k, 0, 0, n, k) for k, n in enumerate(lengths)]
    items = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    count = {
        rounds: packing.pack(items, 2048, 32, rounds).select("sequence_id").distinct().count() for rounds in (1, 4)
    }
    assert packing.lower_bound(np.array(lengths)) <= count[4] <= count[1]


def test_nothing_to_pack(spark):
    assert packing.pack_documents(documents(spark, []), queries.vocabulary()).count() == 0


def test_documents_are_encoded_whole_as_by_the_library(spark):
    """In one call each: before, every word went through a cache of its own bytes."""
    assert not hasattr(packing, "Cache")
    path = queries.vocabulary()
    library = tokens.Encoder(path).library
    texts = ["", " ", "a  b\n\n c", "x<|endoftext|> y", "\ufeffé 中文\u3000 don't 12345", "\u200b\x1c\x85 z ", None]
    docs = documents(spark, [(k, t, "en", "s", 1, "", "", "", "") for k, t in enumerate(texts)])
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.pieces(docs, path, keep_ids=True).collect()}
    assert found == {k: [*library.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
