import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import awkward, bag, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import alignment, bitmaps, queries

A_PATH, B_PATH = queries.vocabulary(), queries.vocabulary(queries.PIECES)
A, B = alignment.ByteVocabulary(A_PATH), alignment.PieceVocabulary(B_PATH)


def tokens_of(text):
    """Ids of the whole text by both libraries; none where they don't give its bytes."""
    if not text:
        return [], []
    a = A.library.encode(f" {text}", add_special_tokens=False).ids
    b = B.library.encode(text)
    same = all(b"".join(v.bytes[i] for i in ids) == f" {text}".encode() for v, ids in ((A, a), (B, b)))
    return (a, b) if same else ([], [])


def links_of(a, b):
    """Pairs of places whose byte ranges overlap, and the groups, byte by byte."""
    over_a = [n for n, i in enumerate(a) for _ in A.bytes[i]]
    over_b = [n for n, i in enumerate(b) for _ in B.bytes[i]]
    links = sorted(set(zip(over_a, over_b)))
    groups, at_a, at_b = [], 0, 0
    for k in range(len(over_a)):
        if over_a[k : k + 1] != over_a[k + 1 : k + 2] and over_b[k : k + 1] != over_b[k + 1 : k + 2]:
            groups.append((a[at_a : over_a[k] + 1], b[at_b : over_b[k] + 1]))
            at_a, at_b = over_a[k] + 1, over_b[k] + 1
    return [(a[x], b[y]) for x, y in links], groups


def brute(rows):
    cut = [(r[0], *tokens_of(r[1])) for r in rows]
    linked = [links_of(a, b) for _, a, b in cut]
    count = Counter(pair for links, _ in linked for pair in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    found = []
    for (doc, a, b), (links, groups) in zip(cut, linked):
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if a else ""
        best = sum(count[pair] == most[pair[1]] for pair in links)
        found.append((doc, len(a), len(b), len(groups), len(links), best, sum(count[pair] for pair in links), digest))
    return found


ODD = [
    (400, "a  b \n c\t d  ", "en", "s", 1), (401, " ", "en", "s", 1), (402, "<|endoftext|> x</s><unk> <s>", "en", "s", 1),
    (403, "one▁two", "en", "s", 1), (404, "中文字 é ﬁ \U0001f600 á ́b   　x", "en", "s", 1), (405, "\x00 \x01a", "en", "s", 1),
]


def cases():
    return awkward() + [(*r, "clash", "clash", "clash", "clash") for r in ODD]


def test_equals_whole_texts_byte_by_byte(spark):
    rows = cases()
    assert bag(alignment.align(documents(spark, rows), A_PATH, B_PATH).collect()) == bag(brute(rows))
    assert alignment.align(documents(spark, []), A_PATH, B_PATH).count() == 0


def test_small_containers_and_caches_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(alignment, "POSTINGS", 50)
    monkeypatch.setattr(alignment, "WORDS_AT_ONCE", 40)
    monkeypatch.setattr(alignment, "CACHED_PIECES", 5)
    rows = cases()
    assert bag(alignment.align(documents(spark, rows), A_PATH, B_PATH).collect()) == bag(brute(rows))


def test_pair_table_counts_documents_and_links(spark):
    rows = cases()
    found = alignment.index(documents(spark, rows), A_PATH, B_PATH)
    table = alignment.pair_counts(found.where("a is not null")).select("a", "b", "documents", "links").collect()
    linked = [links_of(*tokens_of(r[1]))[0] for r in rows]
    links = Counter(pair for x in linked for pair in x)
    held = Counter(pair for x in linked for pair in set(x))
    assert {(r[0], r[1]): (r[2], r[3]) for r in table} == {pair: (held[pair], n) for pair, n in links.items()}


def test_extra_columns_may_clash(spark):
    rows = cases()
    frame = documents(spark, rows).withColumnsRenamed({"score": "row", "kept": "container", "route": "planes", "anchor": "links"})
    assert bag(alignment.align(frame, A_PATH, B_PATH).collect()) == bag(brute(rows))


TEXTS = st.lists(st.sampled_from(["a", " ", "  ", "<|endoftext|>", "\n", "don't", " 12", "é", "the", "▁", "中", "</s>", "​", "́", "\x00"])).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS | st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_pieces_align_as_the_whole_text(text):
    aligned = test_pieces_align_as_the_whole_text.__dict__.setdefault("aligned", alignment.Aligned(A_PATH, B_PATH))
    (sizes,), (digest,), _, codes = aligned.documents([text])
    a, b = tokens_of(text)
    links, groups = links_of(a, b)
    written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    assert sizes.tolist() == [len(a), len(b), len(groups), len(links)]
    assert Counter(codes.tolist()) == Counter(x * len(B.bytes) + y for x, y in links)
    assert digest == (hashlib.sha256(written.encode()).hexdigest() if a else "")


@pytest.mark.parametrize("most", [5, 70_000])
def test_bitmaps_give_back_what_they_hold(most):
    draw = np.random.default_rng(most)
    sizes = np.array([0, 1, 4095, 4096, 65536, 0, 7, 30_000])
    members = np.concatenate([np.sort(draw.permutation(bitmaps.NUMBERS)[:n]) for n in sizes])
    held = bitmaps.packed(members, sizes.copy())
    assert max(len(x) for x in held.to_pylist()) == bitmaps.FULL_BYTES
    for begin, end in ((0, 8), (2, 5), (4, 4), (5, 8)):
        found, counts = bitmaps.unpacked(held.slice(begin, end - begin))
        assert counts.tolist() == sizes[begin:end].tolist()
        assert (found == members[sizes[:begin].sum() : sizes[:end].sum()]).all()
    keys = np.unique(draw.integers(0, 9, 60_000) << 18 | draw.integers(0, bitmaps.NUMBERS, 60_000))
    counts = draw.integers(1, most, len(keys))
    things, planes = bitmaps.multiplicity_planes(keys, counts)
    documents_held, totals = bitmaps.document_counts(planes)
    assert things.tolist() == np.unique(keys >> 16).tolist()
    for n, thing in enumerate(things):
        own = keys >> 16 == thing
        assert (documents_held[n], totals[n]) == (own.sum(), counts[own].sum())
    half, doubled = bitmaps.document_counts(pa.array(planes.to_pylist(), planes.type).slice(3, 4))
    assert (half.tolist(), doubled.tolist()) == (documents_held[3:7].tolist(), totals[3:7].tolist())
