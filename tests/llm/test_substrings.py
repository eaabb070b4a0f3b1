import hashlib
import random

import numpy as np
import pytest
from cases import awkward, bag, documents

from tidewell.llm import substrings
from tidewell.llm.fmindex import Bits, FMIndex, Wavelet, suffix_order


def brute(rows):
    first = {}
    for r in rows:
        words = (r[1] or "").encode().split()
        for k in range(len(words) - 49):
            if r[0] is not None:
                window = tuple(words[k : k + 50])
                first[window] = min(first.get(window, r[0]), r[0])
    out = []
    for r in rows:
        words = (r[1] or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 49):
            if r[0] is not None and first[tuple(words[k : k + 50])] < r[0]:
                gone[k : k + 50] = [True] * 50
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((r[0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return bag(out)


def shared_passages(seed=5):
    pick = random.Random(seed)
    passage = [f"p{k}" for k in range(90)]
    rows = []
    for d in range(150):
        words = [pick.choice("abcdef") + str(pick.randint(0, 50)) for _ in range(pick.randint(0, 120))]
        if pick.random() < 0.6:
            at = pick.randint(0, len(words))
            words[at:at] = passage[pick.randint(0, 25) : pick.randint(55, 90)]
        rows.append((d, " ".join(words), "en", "s", 1, "", "", "", ""))
    return rows


def test_awkward_documents(spark):
    assert bag(substrings.without_repeats(documents(spark)).collect()) == brute(awkward())


@pytest.mark.parametrize("crowd", [10, 2000])
def test_passages_in_many_documents(spark, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "PASSAGES", crowd)
    rows = shared_passages()
    assert bag(substrings.without_repeats(documents(spark, rows)).collect()) == brute(rows)


def test_no_documents(spark):
    assert substrings.without_repeats(documents(spark, [])).count() == 0


def test_equal_windows_have_equal_anchors():
    pick = np.random.default_rng(2)
    words = pick.integers(0, 1 << 60, 300, dtype=np.uint64)
    other = np.concatenate([pick.integers(0, 1 << 60, 37, dtype=np.uint64), words[100:180]])
    rolling = substrings.Rolling()
    a, b = substrings.anchors(words, rolling), substrings.anchors(other, rolling)
    assert (a[100 : 100 + 31] == b[37:]).all()
    start, length = substrings.runs(a)
    assert length.sum() == len(a) and all(len(set(a[s : s + n])) == 1 for s, n in zip(start, length))


def test_index_against_plain_search():
    pick = random.Random(3)
    for _ in range(40):
        length = pick.choice([2, 3, 5])
        made = [np.array([pick.randint(1, 6) for _ in range(pick.randint(1, 25))], np.uint64) for _ in range(pick.randint(1, 10))]
        values = np.array([pick.randint(0, 50) for _ in made])
        asked = made + [np.array([pick.randint(1, 8) for _ in range(pick.randint(0, 25))], np.uint64) for _ in range(8)]
        for pattern, found in zip(asked, FMIndex(made, values, length).least_values(asked, 99)):
            for k, least in enumerate(found):
                holds = [v for s, v in zip(made, values) if any((s[j : j + length] == pattern[k : k + length]).all() for j in range(len(s) - length + 1))]
                assert least == min(holds, default=99)


def test_index_of_nothing():
    assert [list(x) for x in FMIndex([], np.empty(0), 3).least_values([np.arange(5)], -1)] == [[-1, -1, -1]]


def test_ranks():
    symbols = np.random.default_rng(1).integers(0, 11, 300)
    tree = Wavelet(symbols, 4)
    begin = tree.begin(np.arange(11))
    for c in range(11):
        places = np.arange(301)
        got = tree.rank(np.full(301, c), places, np.full(301, begin[c]))
        assert (got == [np.count_nonzero(symbols[:p] == c) for p in places]).all()
    bits = Bits((symbols > 5).astype(np.uint8))
    assert (bits.ones(np.arange(301)) == np.concatenate([[0], np.cumsum(symbols > 5)])).all()
    order = suffix_order(np.array([2, 1, 2, 1, 0]))
    assert list(order) == [4, 3, 1, 2, 0]


def test_a_line_repeated_in_a_document_is_one_passage(spark, monkeypatch):
    line = [f"w{k}" for k in range(12)]
    rows = [(d, " ".join([f"a{d}", *line * 30, f"z{d}", *line * 10]), "en", "s", 1, "", "", "", "") for d in range(6)]
    settled = {}
    kept = substrings.settle
    monkeypatch.setattr(substrings, "settle", lambda df, label: settled.setdefault(label, kept(df, label)))
    monkeypatch.setattr(substrings, "PASSAGES", 3)
    assert bag(substrings.without_repeats(documents(spark, rows)).collect()) == brute(rows)
    by_document = settled["passages"].groupBy("doc_id").count().collect()
    # 12 windows of the line, 49 around each place that is the document's own
    assert len(by_document) == 6 and all(r["count"] <= 12 + 4 * 50 for r in by_document)
