import random

from cases import awkward, bag, documents
from conftest import physical
from pyspark.sql import functions as F

from tidewell.llm import neardup


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    """Components by comparing all pairs; rows of one id are one document."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return bag((d, len(x), None if d is None else find(d), d is None or find(d) == d) for d, x in sets)


def near_copies(seed=3, n=120):
    """A base with copies that differ in few words each, mostly below the threshold to each other."""
    pick = random.Random(seed)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(pick.choice([0, 1, 2, 3, 4, 8])):
            words[pick.randrange(200)] = f"e{pick.randint(0, 10**6)}"
        rows.append((1000 + k, " ".join(words)))
    rows += [(k, " ".join(pick.choice(base) for _ in range(30))) for k in range(30)]
    return [(d, t, "en", "s", 1, "", "", "", "") for d, t in rows]


def test_awkward_documents(spark):
    found = neardup.near_duplicates(documents(spark)).select("doc_id", "n_shingles", "component_id", "kept")
    assert bag(found.collect()) == brute(awkward())


def test_a_group_of_unlike_copies(spark):
    rows = near_copies()
    found = neardup.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert bag(found.collect()) == brute(rows)


def test_short_and_cased_texts(spark):
    rows = [(1, "a b c"), (2, "A  B\tC"), (3, "a b"), (4, "É b c d e f"), (5, "é b c d e f"), (6, "a b c d")]
    rows = [(d, t, None, None, None, "", "", "", "") for d, t in rows]
    found = neardup.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert bag(found.collect()) == brute(rows)


def test_no_documents(spark):
    assert neardup.near_duplicates(documents(spark, [])).count() == 0
    assert neardup.keep_one(documents(spark, [])).count() == 0


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = documents(spark)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in neardup.near_duplicates(docs).where("kept").collect()}
    assert bag(kept.collect()) == bag(r for r in awkward() if r[0] in ids)


def test_components(spark):
    pick = random.Random(9)
    links = [(pick.randint(0, 60), pick.randint(0, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    found = neardup.components(spark.createDataFrame(links, "a long, b long"))
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert bag(found.collect()) == bag((x, find(x)) for x in list(root) if x not in alone)


def test_a_row_meets_the_rows_right_before_it(spark):
    rows = [(0, b"\0" * 8 + bytes([k]), k, c) for k, c in enumerate([0, 1, 2, 3, 4, 4, 6, 4, 6])]
    frame = spark.createDataFrame(rows, "tree int, label binary, node long, component long").coalesce(1)
    walked = neardup._walk(frame.sortWithinPartitions("tree", "label"), "long").where("a is not null")
    found = {(r["a"], r["b"]) for r in walked.collect()}
    met = set()
    for k, row in enumerate(rows):
        met |= {(w[2], row[2]) for w in [w for w in rows[:k] if w[3] != row[3]][-neardup.NEIGHBOURS:]}
    assert found == met


def planted_among_templates(pairs, fillers, seed, template=175, own=25, changed=3):
    """Documents that share most words but not enough, and pairs that are linked to nothing else."""
    pick = random.Random(seed)
    base = [f"t{k}" for k in range(template)]
    texts = []
    for _ in range(fillers):
        texts.append(base + [f"o{pick.randint(0, 10**9)}" for _ in range(own)])
    for _ in range(pairs):
        words = base + [f"p{pick.randint(0, 10**9)}" for _ in range(own)]
        copy = list(words)
        for k in range(changed):
            copy[template + 4 + 6 * k] = f"c{pick.randint(0, 10**9)}"
        texts += [words, copy]
    order = list(range(len(texts)))
    pick.shuffle(order)
    return [(place, " ".join(texts[k]), "en", "s", 1, "", "", "", "") for place, k in enumerate(order)]


def test_planted_pairs_among_templates_are_all_linked(spark):
    rows = planted_among_templates(pairs=60, fillers=500, seed=5)
    found = neardup.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert bag(found.collect()) == brute(rows)


def test_copies_from_four_fifths_on(spark):
    # four standard deviations of the agreement of 128 minima
    assert abs(neardup.agreeing((80, 100)) - 0.6586) < 0.001
    rows = []
    for k in range(60):
        words = [f"s{k}_{n}" for n in range(204)]
        # 200 shingles, of which 20 and some change: similarities on both sides of 0.8
        copy = [f"x{n}" if n in (10, 50, 90, 130) or 170 <= n < 170 + k % 6 else w for n, w in enumerate(words)]
        rows += [(d, " ".join(t), "en", "s", 1, "", "", "", "") for d, t in ((5000 + k, words), (6000 + k, copy))]
    want = {5000 + k for k in range(60)}
    for k in range(60):
        x, y = shingles(rows[2 * k][1]), shingles(rows[2 * k + 1][1])
        if 100 * len(x & y) < 80 * len(x | y):
            want.add(6000 + k)
    kept = {r["doc_id"] for r in neardup.keep_one(documents(spark, rows), (80, 100)).collect()}
    assert kept == want and 60 < len(want) < 120


def test_a_region_of_many_unlike_classes_sends_a_forest(spark, monkeypatch):
    """Copies of one original that are mostly too unlike each other, and pairs among them."""
    monkeypatch.setattr(neardup, "BLOCK", 64)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 200_000)
    rows = planted_among_templates(pairs=40, fillers=400, seed=11, template=184, own=16, changed=2)
    docs = documents(spark, rows)
    classes = neardup._members(docs).where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature"))
    classes = neardup.settle(classes, "classes")
    orders = [
        classes.selectExpr(f"{t} as tree", f"substring(signature, {2 * neardup.DEPTH * t + 1}, {2 * neardup.DEPTH}) as label", "node", "node as component")
        for t in range(neardup.TREES)
    ]
    whole = orders[0]
    for more in orders[1:]:
        whole = whole.unionAll(more)
    whole = neardup.settle(whole, "orders")
    n, least = classes.count(), neardup.agreeing(neardup.THRESHOLD)
    blocks = -(-n // 64) + 3
    candidates = neardup._candidate_links(whole, classes, least).count()
    agreeing = neardup._likely(classes.selectExpr("node as a").join(classes.selectExpr("node as b")).where("a < b"), classes, least).count()
    assert agreeing > n * n / 8
    assert candidates < neardup.TREES * n * blocks
    links = neardup._region_links(docs, whole, classes, neardup.THRESHOLD)
    assert links.count() < n * blocks
    found = neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
    assert bag(found.collect()) == brute(rows)


def test_every_class_of_a_component_meets_an_unlike_one(spark):
    """A component of many classes that agree with another one, of which one class alone is similar enough."""
    words = [f"b{k}" for k in range(204)]
    pick = random.Random(4)
    rows = {100: words, 39: [f"y{k}" if k in (50, 51, 52, 120) else w for k, w in enumerate(words)]}
    for n in range(39):
        # 22 of 200 shingles changed: below the threshold, above what signatures tell apart
        places = {start + k for start in (pick.randrange(10, 85), pick.randrange(100, 185)) for k in range(7)}
        rows[n] = [f"z{n}_{k}" if k in places else w for k, w in enumerate(words)]
    sets = {n: shingles(" ".join(w)) for n, w in rows.items()}
    close = {n for n in rows if n != 100 and 100 * len(sets[n] & sets[100]) >= 85 * len(sets[n] | sets[100])}
    assert close == {39}
    docs = documents(spark, [(n, " ".join(w), "en", "s", 1, "", "", "", "") for n, w in rows.items()])
    members = neardup._members(docs)
    classes = neardup.settle(members.select("digest", F.col("doc_id").alias("node"), "signature"), "classes")
    size = 2 * neardup.DEPTH
    labels = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), F.substring("signature", size * t + 1, size).alias("label")) for t in range(neardup.TREES)]))
    component = F.when(F.col("node") == 100, F.col("node")).otherwise(F.lit(0).cast("long")).alias("component")
    orders = neardup.settle(classes.select("node", component, labels.alias("l")).select("l.tree", "l.label", "node", "component"), "orders")
    least = neardup.agreeing(neardup.THRESHOLD)
    regions = {}
    for r in orders.collect():
        regions.setdefault((r["tree"], bytes(r["label"][: 2 * neardup.PREFIX])), set()).add(r["node"])
    shared = set().union(*(nodes for nodes in regions.values() if 100 in nodes and len(nodes) > neardup.NEIGHBOURS + 1))
    pairs = spark.createDataFrame([(n, 100) for n in shared - {100}], "a long, b long")
    agreeing = {r["a"] for r in neardup._likely(pairs, classes, least).collect()}
    assert len(agreeing) > 10 and 39 in agreeing
    candidates = [tuple(sorted(r)) for r in neardup._candidate_links(orders, classes, least).collect()]
    assert {n for pair in candidates for n in pair} == agreeing | {100}
    links = {tuple(sorted(r)) for r in neardup._region_links(docs, orders, classes, neardup.THRESHOLD).collect()}
    assert links == {(39, 100)}


def test_a_class_meets_the_hubs_of_a_region_in_one_row(spark, monkeypatch):
    settled = {}
    kept = neardup.settle
    monkeypatch.setattr(neardup, "settle", lambda df, label: settled.setdefault(label, kept(df, label)))
    near, heavy = (0, b"aaaaaaaa" + b"x" * 8), (1, b"bbbbbbbb" + b"y" * 8)
    rows = [(*near, n, n if n < 25 else 3) for n in range(30)] + [(*heavy, n, n) for n in range(28, 34)]
    rows = spark.createDataFrame(rows, "tree int, label binary, node long, component long")
    weights = spark.createDataFrame([(n, 1 - n / 100) for n in range(32)], "node long, weight double")
    wanted = {(a, b) for a in range(8) for b in range(30) if a != b and not (a == 3 and b >= 25)}
    wanted |= {(a, b) for a in range(28, 32) for b in range(28, 34) if a != b}
    found = neardup._hub_pairs(rows, weights)
    assert sorted(tuple(r) for r in found.collect()) == sorted({(min(p), max(p)) for p in wanted})
    assert settled["hubs"].count() == 2


def test_hubs_are_met_in_one_walk(spark, monkeypatch):
    """The hub pairs of later walks are among those of the first, so they are not made again."""
    walked, met = [], []
    walk, hubs = neardup.neighbour_pairs, neardup._hub_pairs
    monkeypatch.setattr(neardup, "neighbour_pairs", lambda rows: walked.append(rows) or walk(rows))
    monkeypatch.setattr(neardup, "_hub_pairs", lambda rows, weights: met.append((len(walked), weights)) or hubs(rows, weights))
    rows = planted_among_templates(pairs=100, fillers=300, seed=5, template=184, own=16, changed=2)
    found = neardup.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert bag(found.collect()) == brute(rows)
    assert len(walked) > 2 and [k for k, _ in met] == [2]
    first, *later = ({tuple(r) for r in hubs(rows, met[0][1]).collect()} for rows in walked[1:])
    assert first and all(pairs <= first for pairs in later)


def test_pairs_seen_are_written_and_not_joined_again(spark, monkeypatch):
    plans = []
    likely = neardup._likely
    monkeypatch.setattr(neardup, "_likely", lambda pairs, *more: plans.append(physical(pairs)) or likely(pairs, *more))
    rows = near_copies(n=60)
    found = neardup.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert bag(found.collect()) == brute(rows)
    assert len(plans) > 1 and not any("Join" in plan for plan in plans)
