"""Quality classifier, language identification and nearest neighbours."""

import random
import zlib

import numpy as np
import pytest
from cases import awkward, bag, documents
from pyspark.sql import functions as F

from tidewell.llm import language, neighbours, quality
from tidewell.llm.workers import Rows, ngram_hashes, sums


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 3 == 1


def corpus(n=400, seed=1):
    """Documents of two languages, some of them junk."""
    pick = random.Random(seed)
    vocabulary = {"xx": ["the", "thing", "with", "from", "north", "there"], "yy": ["que", "cosa", "pour", "niño", "ciel", "où"]}
    rows, labels = [], []
    for d in range(n):
        lang = pick.choice(["xx", "yy"])
        words = [pick.choice(vocabulary[lang]) + pick.choice(["", "s", "er"]) for _ in range(pick.randint(8, 60))]
        junk = pick.random() < 0.3
        if junk:
            words = [w.upper() + "!!" for w in words] if pick.random() < 0.5 else [words[0]] * len(words)
        rows.append((d, " ".join(words), lang, "s", 1, "", "", "", ""))
        labels.append((d, int(not junk), 0))
    return rows, labels


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_documents(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    found = {r["doc_id"]: r for r in quality.score(docs, quality.fit(docs, labelled(spark, labels))).collect()}
    assert len(found) == len(rows)
    right = [found[d]["predicted"] == q for d, q, _ in labels if is_held_out(d)]
    assert sum(right) / len(right) > 0.9
    assert all(found[d]["held_out"] == is_held_out(d) for d in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_quality_does_not_learn_from_held_out_labels(spark):
    rows, labels = corpus(120)
    docs = documents(spark, rows)
    turned = [(d, 1 - q if is_held_out(d) else q, t) for d, q, t in labels]
    one, two = (quality.fit(docs, labelled(spark, x)) for x in (labels, turned))
    assert (one.weights == two.weights).all() and one.bias == two.bias


def test_quality_scores_as_a_plain_sum(spark):
    rows, labels = corpus(120)
    docs = documents(spark, rows)
    model = quality.fit(docs, labelled(spark, labels))
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for r in rows[:30]:
        found = quality.features(r[1].split())
        z = model.weights[found].mean() + model.bias
        assert scored[r[0]] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_quality_of_awkward_documents(spark):
    docs = documents(spark)
    labels = [(k, k % 2, 0) for k in range(40)] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (5, 0, 0), (999, 1, 1)]
    model = quality.fit(docs, labelled(spark, labels))
    scored = quality.score(docs, model).collect()
    assert bag([r["doc_id"] for r in scored].__iter__() and [(r["doc_id"],) for r in scored]) == bag((r[0],) for r in awkward())
    empty = [r["score"] for r in scored if r["doc_id"] in (200, 201, 202)]
    assert empty == [empty[0]] * 3
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.count() == sum(r["predicted"] for r in scored)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1, 0), (2, 1, 0), (5, 1, 0)], None)])
def test_quality_without_both_classes(spark, labels, score):
    model = quality.fit(documents(spark), labelled(spark, labels))
    scored = {r["score"] for r in quality.score(documents(spark), model).collect()}
    assert len(scored) == 1 and (score is None or scored == {score})
    assert quality.score(documents(spark, []), model).count() == 0


def test_language_on_held_out_documents(spark):
    rows, _ = corpus()
    docs = documents(spark, rows)
    found = {r["doc_id"]: r for r in language.identify(docs, language.fit(docs)).collect()}
    right = [found[r[0]]["lang_pred"] == r[2] for r in rows if is_held_out(r[0])]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_models_are_distributions(spark):
    rows, _ = corpus(60)
    model = language.fit(documents(spark, rows))
    letters = sorted({c for r in rows for c in r[1].lower() if c.isalpha()} | {"\x03"})
    for context in ("\x02\x02\x02", "\x02\x02t", "the", "ing", "zzz"):
        columns = [np.array([ord(c) for _ in letters], np.uint64) for c in context]
        total = np.exp(model.log_probabilities([*columns, np.array([ord(c) for c in letters], np.uint64)])).sum(axis=0)
        # the rest is for a letter never seen
        rest = np.exp(model.log_probabilities([*(c[:1] for c in columns), np.array([ord("ж")], np.uint64)]))[0]
        assert total + rest == pytest.approx(np.ones(len(model.languages)), abs=1e-4)


def plain_kneser_ney(counts, discounts, alphabet, gram):
    """The recursion as it is written in the literature; ``counts`` by order."""
    if not gram:
        return 1 / alphabet
    level = counts[len(gram)]
    context = {g: n for g, n in level.items() if g[:-1] == gram[:-1]}
    below = plain_kneser_ney(counts, discounts, alphabet, gram[1:])
    if not context:
        return below
    total, d = sum(context.values()), discounts[len(gram)]
    return max(context.get(gram, 0) - d, 0) / total + d * len(context) / total * below


def test_language_model_against_the_recursion():
    words = {"abab": 3, "abc": 2, "ba": 5, "cab": 1}
    grams = {}
    for w, n in words.items():
        padded = "\x02\x02\x02" + w + "\x03"
        for k in range(len(w) + 1):
            grams[padded[k : k + 4]] = grams.get(padded[k : k + 4], 0) + n
    names = sorted(grams)
    model = language._model(["l"], np.zeros(len(names), np.int64), names, np.array([grams[g] for g in names]))
    counts = {4: grams}
    for order in (3, 2, 1):
        counts[order] = {}
        for g in counts[order + 1]:
            counts[order][g[1:]] = counts[order].get(g[1:], 0) + 1
    discounts = {}
    for order, level in counts.items():
        once, twice = (sum(n == k for n in level.values()) for k in (1, 2))
        discounts[order] = min(0.9, max(0.1, once / max(once + 2 * twice, 1)))
    alphabet = len(counts[1]) + 1
    for gram in [*names, "abca", "xyza", "\x02\x02\x02c", "bbbb", "abab"]:
        got = model.log_probabilities([np.array([ord(c)], np.uint64) for c in gram])[0, 0]
        assert np.exp(got) == pytest.approx(plain_kneser_ney(counts, discounts, alphabet, gram), rel=1e-5)


def test_language_of_awkward_documents(spark):
    docs = documents(spark)
    found = language.identify(docs, language.fit(docs)).collect()
    assert bag((r["doc_id"],) for r in found) == bag((r[0],) for r in awkward())
    no_letters = [r for r in found if r["doc_id"] in (200, 201, 202)]
    assert all((r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True) for r in no_letters)
    assert {r["lang_pred"] for r in found} <= {"en", "de", "und"}
    empty = documents(spark, [])
    assert language.identify(empty, language.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, None).collect()} == {"und"}


def test_rejection_of_an_unknown_language(spark):
    rows, _ = corpus()
    model = language.fit(documents(spark, rows))
    strange = documents(spark, [(1, "ζήτα κάππα λάμδα όμικρον", None, "s", 1, "", "", "", "")])
    assert language.identify(strange, model).first()["rejected"]


def test_a_bounded_model_keeps_the_frequent_grams(spark):
    rows, _ = corpus(100)
    small = language.fit(documents(spark, rows), cells=200)
    assert 0 < len(small.grams[-1][0]) * len(small.languages) <= 200


VECTORS = "vec_id long, embedding array<float>, label int, score string, rank string, shard string"


def vectors(n=700, seed=4):
    pick = np.random.default_rng(seed)
    made = pick.standard_normal((n, 16)).astype(np.float32)
    made[50:90] = made[50]
    made[100:140] = made[100] + 0.1 * pick.standard_normal((40, 16)).astype(np.float32)
    rows = [(k, [float(x) for x in v], 1, "", "", "") for k, v in enumerate(made)]
    rows += [(1000, None, 1, "", "", ""), (1050, [0.0] * 16, 1, "", "", ""), (1100, [float("nan")] * 16, 1, "", "", "")]
    rows += [(1150, [None] * 16, 1, "", "", ""), (1200, [], 1, "", "", ""), (1250, [1.0, 2.0, 3.0], 1, "", "", ""), (None, [1.0] * 16, 1, "", "", "")]
    rows += [rows[50], rows[60], (61, rows[3][1], 1, "", "", "")]
    return rows


def nearest_by_all(rows, k=5):
    usable = [(d, np.array(v, float)) for d, v, *_ in rows if d is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for d, v in usable:
        if d % 50 == 0:
            best = out.setdefault(d, {})
            for e, w in usable:
                if e != d and len(w) == len(v):
                    best[e] = max(best.get(e, -2), float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))))
    return {d: sorted(b.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k] for d, b in out.items() if b}


def test_neighbours(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = nearest_by_all(rows)
    assert set(found) == set(want)
    hits = 0
    for query, best in want.items():
        have = dict(found[query])
        hits += len(set(have) & {e for e, _ in best})
        every = dict(nearest_by_all(rows, 10**6)[query]) if query in (0, 50) else None
        if every:
            assert all(abs(every[e] - s) < 1e-12 for e, s in have.items())
        assert len(found[query]) == len(best)
    assert hits / sum(map(len, want.values())) >= 0.95
    # equal vectors: ties go to the smaller ids
    assert [e for e, _ in found[50]] == [51, 52, 53, 54, 55]


def test_fewer_vectors_than_neighbours(spark):
    rows = [(k, [1.0 * (k == 0), 1.0, 0.5 * k - 1], 0, "", "", "") for k in range(3)]
    found = neighbours.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0)
    assert found.count() == 2
    assert neighbours.nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


def test_worker_tables():
    rows = Rows(lambda words: (np.array([float(len(w)) for w in words]),), most=3)
    for words in (["a", "bb"], ["bb", "ccc", "a"], ["dddd", "e"]):
        numbers = rows.numbers(words)
        assert list(rows.tables()[0][numbers]) == [len(w) for w in words]
    rows.rest()
    assert not rows and list(rows.tables() or []) == []
    assert list(sums(np.array([1.0, 2.0, 3.0]), np.array([0, 2, 0, 1]))) == [0, 3, 0, 3]
    codes, owner = ngram_hashes(["ab", "", "abc"], (3,))
    assert list(owner) == [0, 0, 2, 2, 2] and codes[0] == codes[2]


def test_texts_without_a_letter_have_no_language(spark):
    rows = [(k, "the of and to in is it " * 3, "en", "s", 1, "", "", "", "") for k in range(40)]
    rows += [(100 + k, text, "en", "s", 1, "", "", "", "") for k, text in enumerate(["² ½ 12", "Ⅷ", "③ ٣", "_", "", None])]
    docs = documents(spark, rows)
    found = {r["doc_id"]: r for r in language.identify(docs, language.fit(docs)).collect()}
    assert [(found[100 + k]["lang_pred"], found[100 + k]["score"]) for k in range(6)] == [("und", 0.0)] * 6
    assert found[0]["lang_pred"] == "en"


def test_language_does_not_depend_on_what_tasks_can_hold(spark):
    rows, _ = corpus(90)
    rows += [(1000 + k, text, lang, "s", 1, "", "", "", "") for k, (text, lang) in enumerate([("ΩMEGA ciel", "zz"), ("the 𝔘nion x²", "zz"), ("ж", None), (None, "xx"), ("", "xx"), ("12", None)])]
    rows += rows[:5] + [(None, "the north", None, "s", 1, "", "", "", "")] * 2
    docs = documents(spark, rows)
    whole = bag(tuple(r) for r in language.identify(docs, language.fit(docs)).collect())
    for cells in (100, 0):
        model = language.fit(docs, cells=cells)
        assert bool(cells) <= model.grams[-1][1].size <= cells
        assert bag(tuple(r) for r in language.identify(docs, model).collect()) == whole
