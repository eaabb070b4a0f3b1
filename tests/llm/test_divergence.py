import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from cases import awkward, documents

from tidewell.llm import divergence, queries


def brute(rows, least, ranks):
    """The audit in plain Python integers, term by term."""
    lower = {c: c + 32 for c in range(65, 91)}
    texts = [(r[2] or "", r[3] or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (r[1] or "").translate(lower))) for r in rows]
    found = []
    for lang in {t[0] for t in texts}:
        inside = [t for t in texts if t[0] == lang]
        held = Counter(x for t in inside for x in set(t[2]))
        kept = [x for x, n in held.items() if n >= least]
        counts = {s: Counter(x for t in inside if t[1] == s for x in t[2] if held[x] >= least) for s in {t[1] for t in inside}}
        whole = sum(counts.values(), Counter())

        def p(count, x):
            return 1 + 10**9 * (count[x] + 2) // (count.total() + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for source, own in counts.items():
            pairs = [(s, sum(f(p(own, x), p(c, x)) for x in kept)) for s, c in counts.items() if s != source]
            terms = [(x, f(p(own, x), p(whole, x))) for x in kept if own[x] and p(own, x) > p(whole, x)]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda i: (-i[1], i[0].encode()))
                found += [(lang, source, part, *i, n + 1) for n, i in enumerate(items) if part == "pair" or n < ranks]
    return sorted(found)


def rows_of(found):
    return sorted(tuple(r) for r in found.collect())


def sourced(seed=3):
    """The awkward documents under several sources, one of them hot, some null."""
    names = ["hot", "hot", "Zebra", "äther", None, ""]
    return [(*r[:3], names[(seed * n * n) % 6], *r[4:]) for n, r in enumerate(awkward(seed, 60))]


@pytest.mark.parametrize("least", [1, 3, 10])
def test_equals_plain_integers(spark, least):
    rows = sourced()
    assert rows_of(divergence.audit(documents(spark, rows), least, 4)) == brute(rows, least, 4)


def test_colliding_digests_are_split(spark):
    rows = sourced()
    assert rows_of(divergence.audit(documents(spark, rows), 3, 4, lambda term: len(term) % 7)) == brute(rows, 3, 4)
    assert rows_of(divergence.audit(documents(spark, rows), 3, 4, lambda term: (1 << 64) - 1)) == brute(rows, 3, 4)


def test_tiles_and_blocks_give_the_same(spark, monkeypatch):
    rows = [(*r[:3], f"s{n % 13}", *r[4:]) for n, r in enumerate(awkward(5, 80))]
    monkeypatch.setattr(divergence, "TILE_SOURCES", 2)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 5)
    assert rows_of(divergence.audit(documents(spark, rows), 2, 10)) == brute(rows, 2, 10)


def test_full_counters_are_flushed(spark, monkeypatch):
    rows = sourced()
    monkeypatch.setattr(divergence, "COUNTED_PER_TASK", 20)
    monkeypatch.setattr(divergence, "GATHERED_PER_TASK", 50)
    assert rows_of(divergence.audit(documents(spark, rows), 3, 4)) == brute(rows, 3, 4)


def test_counts_beyond_what_a_product_holds():
    big = np.array([0, 5, 1 << 60])
    assert divergence.share(big, 1 << 61, 3).tolist() == [10**9 * (n + 2) // ((1 << 61) + 6) + 1 for n in big.tolist()]


def test_nothing_and_groups_without_terms(spark):
    assert rows_of(divergence.audit(documents(spark, []))) == []
    rows = [(1, None, "en", s, 0, "", "", "", "") for s in ("a", "b", None)]
    assert rows_of(divergence.audit(documents(spark, rows))) == brute(rows, 10, 10)
    assert len(brute(rows, 10, 10)) == 6


def test_a_full_table_lets_all_terms_through(spark, monkeypatch):
    rows = sourced()
    monkeypatch.setattr(divergence, "SIEVE_BITS", 6)
    assert rows_of(divergence.audit(documents(spark, rows), 3, 4)) == brute(rows, 3, 4)


def test_the_table_holds_what_is_marked(spark):
    digests = [0, 1, 63, 64, -1, 1 << 40, -(1 << 63), 12345678901234567]
    table = divergence.sieve(spark.createDataFrame([(d,) for d in digests], "digest long"))
    assert divergence.passes(np.array(digests), table).all()
    assert sum(bin(w & (1 << 64) - 1).count("1") for w in table.tolist()) == len({d % (1 << 26) for d in digests})


def test_counting_shuffles_no_string(spark):
    plan = divergence.candidates(documents(spark, sourced()))._jdf.queryExecution().executedPlan().toString()
    assert "lang#" in plan and "term" not in plan and "text#" not in plan.split("MapInArrow")[0]


def test_sql_says_the_same_of_null_and_clashing_columns(spark):
    rows = sourced(4)
    frame = documents(spark, rows).toPandas()  # noqa: F841
    with duckdb.connect() as base:
        base.execute("create view documents as select * from frame")
        want = base.execute(queries.ORACLE_SQL["op13_source_divergence"]).fetchall()
    assert rows_of(divergence.audit(documents(spark, rows))) == sorted(want)
