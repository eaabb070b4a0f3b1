"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds the hashes of its distinct five-word shingles (of its whole
word sequence where that is shorter).  Documents with equal sets form a class, and
only classes go on.  A signature of ``TREES * DEPTH`` minima gives each class one
label per tree.  Each tree is a sorted order of the labels, cut into even ranges, so
no region can gather in one task; every class is paired with the ``NEIGHBOURS``
classes that follow it in the order and share at least ``PREFIX`` minima.  That is
the adaptive depth: where an order is dense, the neighbours share long prefixes,
and where it is sparse, short ones.  At the similarity of 0.85 two classes share a
prefix in some tree with a probability above 0.99999, at 0.8 above 0.9997.

Signatures that agree too little (more than four standard deviations below the
threshold) end a pair; the others are confirmed on the full sets, the likeliest
pairs first.  Pairs whose classes are already in one component need no
confirmation.  Then the orders are walked again over the classes of unlike
components only, until a walk finds no new link: what a dense region hid behind
nearer neighbours comes up once these have merged.  In the first of these later walks
every class is also paired with the ``HUBS`` classes of each of its regions that agree
best with their neighbours, for copies that are each like a common original and less
like each other.  At last, where a region still holds unlike components among more classes
than the walk has compared, the signatures of all its pairs are compared in blocks, so
that what is left out depends on no order.  What agrees is confirmed where the sets of
two blocks meet; every task tells a spanning forest and a link per class, never all pairs.

Null texts and texts without words have an empty set, link with nothing and are
kept.  Rows with a null id link with nothing.  Rows that share an id are one
document.  Columns besides doc_id and text are passed on by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.sieve import only
from tidewell.llm.workers import mixed, slices
from tidewell.session import settle

SHINGLE = 5
TREES, DEPTH, PREFIX = 16, 8, 4
NEIGHBOURS = 2
HUBS = 8
THRESHOLD = (85, 100)
FIRST_CONFIRMED = 2
WALKED_ALONE = 200_000
# Classes of a block whose signatures are compared, and bytes of one whose sets are.
BLOCK = 4096
BLOCK_BYTES = 24 << 20
EDGES_PER_TASK = 250_000


def agreeing(threshold: tuple[int, int]) -> float:
    """Four standard deviations of the agreement of all minima below the threshold."""
    share = threshold[0] / threshold[1]
    return share - 4 * (share * (1 - share) / (TREES * DEPTH)) ** 0.5


class WordHashes(dict):
    """Hash of each word; bounded."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; words are runs of other than ASCII white space."""
    words = hashes.of((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not len(words):
        return words
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(words.tobytes(), len(words))], np.uint64)
    code = words[: len(words) - size + 1]
    for k in range(1, size):
        code = (code ^ (code >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - size + 1 + k]
    return np.unique(mixed(code))


_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 1 << 32, TREES * DEPTH, np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 1 << 32, TREES * DEPTH, np.uint64).astype(np.uint32)


def signature(codes: np.ndarray) -> np.ndarray:
    """16 bits of each minimum, in the byte order in which labels sort."""
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    short = (codes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 2048):
        part = short[start : start + 2048, None] * _FACTORS + _SHIFTS
        np.minimum(low, part.min(axis=0), out=low)
    return (mixed(low.astype(np.uint64)) & np.uint64(0xFFFF)).astype(">u2")


def _members(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature."""

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            sizes, digests, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                codes = shingles(text, hashes)
                sizes.append(len(codes))
                digests.append(xxhash.xxh128_digest(codes.tobytes()) if len(codes) else None)
                signatures.append(signature(codes).tobytes() if len(codes) else None)
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "digest", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, signature binary")


def _walk(rows: DataFrame, kind: str) -> DataFrame:
    """One walk over sorted rows(tree, label, node, component): pairs of neighbours of
    unlike components, and the rows at both ends of each range."""

    def run(batches):
        names = ["a", "b", "tree", "label", "node", "component"]
        node, region, place = None, None, 0
        # by component, the one met last at the end: the last rows of the region, with their places.
        # One component more than NEIGHBOURS is enough to find the latest rows of unlike ones
        last: dict = {}
        first: dict = {}
        head: list[tuple] = []
        opening = None
        pairs: list[tuple] = []

        def flush():
            found = [pa.array([p[0] for p in pairs], node), pa.array([p[1] for p in pairs], node)]
            pairs.clear()
            return pa.record_batch([*found, *[pa.nulls(len(found[0]), t) for t in (pa.int32(), pa.binary(), node, node)]], names)

        for batch in slices(batches):
            node = batch.schema.field("node").type
            for row in zip(*(batch.column(n).to_pylist() for n in names[2:])):
                here = (row[0], row[1][: 2 * PREFIX])
                opening = opening or here
                if here == opening and first.get(row[3], 0) < NEIGHBOURS and (row[3] in first or len(first) <= NEIGHBOURS):
                    first[row[3]] = first.get(row[3], 0) + 1
                    head.append(row)
                if here != region:
                    region, last = here, {}
                place += 1
                near = sorted(w for component, kept in last.items() if component != row[3] for w in kept)[-NEIGHBOURS:]
                pairs.extend((min(w[1][2], row[2]), max(w[1][2], row[2])) for w in near)
                last[row[3]] = [*last.pop(row[3], []), (place, row)][-NEIGHBOURS:]
                if len(last) > NEIGHBOURS + 1:
                    del last[next(iter(last))]
            if len(pairs) > 10_000:
                yield flush()
        if node is not None:
            yield flush()
            ends = list(dict.fromkeys(head + [w[1] for kept in last.values() for w in kept]))
            yield pa.record_batch([pa.nulls(len(ends), node)] * 2 + [pa.array([e[k] for e in ends], t) for k, t in enumerate((pa.int32(), pa.binary(), node, node))], names)

    return rows.mapInArrow(run, f"a {kind}, b {kind}, tree int, label binary, node {kind}, component {kind}")


def neighbour_pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs a < b of classes of unlike components that are neighbours in some order.

    The ends of the ranges are walked again as an order of their own, so that no
    pair is lost at a border.
    """
    kind = rows.schema["node"].dataType.simpleString()
    order = ["tree", "label", "node"]
    found = []
    while True:
        alone = rows.count() <= WALKED_ALONE if found else False
        spread = rows.coalesce(1) if alone else rows.repartitionByRange(*order)
        walked = settle(_walk(spread.sortWithinPartitions(*order), kind), "walk")
        found.append(walked.where(F.col("a").isNotNull()).select("a", "b"))
        if alone:
            break
        rows = walked.where(F.col("a").isNull()).select(*order, "component")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    return pairs.distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """node, component (smallest node reachable) for every node of links(a, b).

    Alternates stars around larger and smaller neighbours until each component is one
    star; every step is written, so a lost executor costs no earlier step, and no
    node's neighbours are gathered.  Steps of few edges take few tasks.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    while not _stars(edges):
        tasks = -(-edges.count() // EDGES_PER_TASK)
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = settle(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low")).coalesce(tasks), label)
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = settle(large.where("u <> v").distinct().coalesce(tasks), label)
        lowest = settle(large.groupBy("u").agg(F.min("v").alias("low")).coalesce(tasks), label)
        small = large.join(lowest, "u")
        # each node keeps its smallest neighbour, which takes the other ones
        small = small.select("u", F.col("low").alias("v")).unionAll(small.select(F.col("v").alias("u"), F.col("low").alias("v")))
        edges = settle(small.where("u <> v").distinct().coalesce(tasks), label)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("below")), F.struct(F.col("v").alias("node"), F.lit(0).alias("below"))))
    ends = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.below").alias("n"), F.min("e.below").alias("least"))
    return ends.where((F.col("n") > 1) | ((F.col("n") > 0) & (F.col("least") == 0))).isEmpty()


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, codes: the full sets of the wanted(node, digest) classes."""

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            nodes, sets = [], []
            for node, digest, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                codes = shingles(text, hashes)
                # a repeated id may have other texts
                if xxhash.xxh128_digest(codes.tobytes()) == digest:
                    nodes.append(node)
                    sets.append(codes.tobytes())
            yield pa.record_batch([pa.array(nodes, batch.schema.field(0).type), pa.array(sets, pa.binary())], ["node", "codes"])

    kind = wanted.schema["node"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # only texts that may be wanted are shuffled
    texts = only(texts, wanted.select(F.col("node").alias("doc_id"))).withColumnRenamed("doc_id", "node")
    rows = texts.join(wanted, "node").select("node", "digest", "text").mapInArrow(run, f"node {kind}, codes binary")
    return rows.dropDuplicates(["node", "codes"])


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches):
        part, whole = threshold
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(whole * both >= part * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    rows = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("codes").alias("x")), "a")
    rows = rows.join(sets.select(F.col("node").alias("b"), F.col("codes").alias("y")), "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def _likely(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """a, b, agreement for the pairs whose signatures agree enough."""
    one = classes.select(F.col("node").alias("a"), F.col("signature").alias("x"))
    two = classes.select(F.col("node").alias("b"), F.col("signature").alias("y"))

    def run(batches):
        for batch in slices(batches):
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, TREES * DEPTH) for k in (2, 3))
            agreement = (x == y).mean(axis=1)
            found = pa.record_batch([batch.column(0), batch.column(1), pa.array(agreement)], ["a", "b", "agreement"])
            yield found.filter(pa.array(agreement >= least))

    kind = pairs.schema["a"].dataType.simpleString()
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, f"a {kind}, b {kind}, agreement double")


def _across(pairs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The pairs whose nodes are not in one component yet."""
    one = grouped.select(F.col("node").alias("a"), F.col("component").alias("x"))
    two = grouped.select(F.col("node").alias("b"), F.col("component").alias("y"))
    rows = pairs.join(one, "a", "left").join(two, "b", "left")
    apart = F.coalesce("x", "a") != F.coalesce("y", "b")
    return rows.where(apart).select(*pairs.columns)


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs(doc_id, text)."""
    members = settle(_members(docs), "members")
    filled = members.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = settle(filled.groupBy("digest").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature")), "classes")
    # equal sets are linked to the class, and an id with several sets to several classes
    equal = filled.select("doc_id", "digest").join(classes.select("digest", "node"), "digest")
    equal = settle(equal.where(F.col("doc_id") != F.col("node")).select(F.col("doc_id").alias("a"), F.col("node").alias("b")), "equal")
    links = [equal, *class_links(docs, classes, threshold)]
    found = settle(components(_union(links)), "found").withColumnRenamed("node", "own")
    answered = members.join(found, members["doc_id"] == found["own"], "left")
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return answered.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def class_links(docs: DataFrame, classes: DataFrame, threshold: tuple[int, int]) -> list[DataFrame]:
    """Confirmed links(a, b) that join all similar classes(digest, node, signature)."""
    labels = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), F.substring("signature", 2 * DEPTH * t + 1, 2 * DEPTH).alias("label")) for t in range(TREES)]))
    rows = settle(classes.select("node", labels.alias("l")).select("l.tree", "l.label", "node"), "orders")
    rows, grouped, sets, seen, confirmed = rows.withColumn("component", F.col("node")), None, None, None, []
    weights, least, met = None, agreeing(threshold), False
    while True:
        pairs = neighbour_pairs(rows)
        if weights is not None and not met:
            # once: the hubs of a region stay the same and components only merge, so all
            # that a later walk could meet at hubs is among the pairs seen by now
            pairs, met = pairs.unionAll(_hub_pairs(rows, weights)).distinct(), True
        pairs = settle(pairs, "pairs")
        if seen is None:
            # classes without a neighbour now have none later
            alone = settle(_nodes(pairs), "nodes")
            rows = settle(rows.join(alone, "node", "left_semi"), "orders")
        else:
            # written, as every later walk reads them again
            pairs = settle(pairs.join(seen, ["a", "b"], "left_anti"), "unseen")
        seen = pairs if seen is None else seen.unionAll(pairs)
        pairs = settle(_likely(pairs, classes, least), "likely")
        before = len(confirmed)
        if not pairs.isEmpty():
            wanted = _nodes(pairs).join(classes.select("node", "digest"), "node")
            wanted = settle(wanted if sets is None else wanted.join(sets.select("node"), "node", "left_anti"), "wanted")
            found = settle(_sets(docs, wanted), "sets")
            sets = found if sets is None else sets.unionAll(found)
            # the likeliest partners of each class first; the others where they still matter
            by_node = pairs.withColumn("node", F.explode(F.array("a", "b")))
            if weights is None:
                weights = settle(by_node.groupBy("node").agg(F.avg("agreement").alias("weight")), "weights")
            place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("agreement"), "a", "b"))
            first = by_node.withColumn("place", place).where(F.col("place") <= FIRST_CONFIRMED).select("a", "b").distinct()
            for more in (first, pairs.select("a", "b")):
                new = settle(_confirmed(more if more is first else _across(more, grouped), sets, threshold), "confirmed")
                if not new.isEmpty():
                    confirmed.append(new)
                if grouped is None or not new.isEmpty():
                    grouped = settle(components(_union(confirmed)) if confirmed else _nothing(new), "grouped")
        if len(confirmed) == before:
            return [*confirmed, _region_links(docs, rows, classes, threshold)]
        # the next walk meets unlike components only
        rows = rows.select("tree", "label", "node").join(grouped, "node", "left")
        rows = settle(rows.select("tree", "label", "node", F.coalesce("component", "node").alias("component")), "orders")


def _agreeing_pairs(signatures: np.ndarray, apart, split: int, least: float):
    """Pairs of rows that agree enough, row by row: (row, partners, agreement, equal minima).

    With a ``split`` the rows before it are compared with those from it on, else all with
    all.  ``apart(row, start)`` marks the rows from start on that matter to a row; what the
    caller notes on the way counts for the rows that follow.
    """
    for n in range(split or len(signatures)):
        start = split or n + 1
        same = signatures[start:] == signatures[n]
        agreement = np.count_nonzero(same, axis=1) / (TREES * DEPTH)
        hits = np.flatnonzero((agreement >= least) & apart(n, start))
        if len(hits):
            yield n, start + hits, agreement[hits], same[hits]


def _tied(signatures: np.ndarray, known: list, tree: int, split: int, least: float) -> list[tuple[int, int]]:
    """Pairs of rows that join all rows of unlike components that agree enough, and name
    every row that does: a link per tree that is joined, and one for a row without any.

    Components are not yet like each other because one pair of theirs agrees, so every row
    of theirs that agrees has to be met on its full set, whatever the others have joined.
    """
    own = np.unique(np.array(known, object), return_inverse=True)[1]
    trees, linked = own.copy(), np.zeros(len(own), bool)

    def apart(n: int, start: int) -> np.ndarray:
        if not linked[n]:
            return own[start:] != own[n]
        return (trees[start:] != trees[n]) | ~linked[start:] & (own[start:] != own[n])

    found = []
    for n, partners, _, same in _agreeing_pairs(signatures, apart, split, least):
        # a pair is told in the first region that it shares
        told = same.reshape(-1, TREES, DEPTH)[:, :tree, :PREFIX].all(axis=2).any(axis=1)
        partners = partners[~told]
        if not len(partners):
            continue
        others, first = np.unique(trees[partners], return_index=True)
        first = first[others != trees[n]]
        chosen = np.union1d(first, np.flatnonzero(~linked[partners]))
        if not len(chosen) and not linked[n]:
            chosen = np.zeros(1, np.int64)
        found.extend((n, p) for p in partners[chosen].tolist())
        if len(chosen):
            linked[n] = linked[partners[chosen]] = True
        if len(first):
            trees[np.isin(trees, others)] = trees[n]
    return found


def _candidate_links(rows: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """a, b: links that join all classes of unlike components that share a region and whose
    signatures agree enough, in regions of more classes than a walk compares.

    A task compares two blocks of a region and tells a spanning forest of the pairs it
    finds and a link of every class in them, so at most two per class.  Blocks hold whole components, or parts of one
    that is large, so that no two blocks of the same one are compared.
    """
    region = ["tree", "prefix"]
    rows = rows.select("tree", F.substring("label", 1, 2 * PREFIX).alias("prefix"), "node", "component")
    sizes = settle(rows.groupBy(*region, "component").agg(F.count("*").alias("m")), "sizes")
    dense = sizes.groupBy(*region).agg(F.sum("m").alias("n"), F.count("*").alias("unlike"))
    dense = dense.where((F.col("n") > NEIGHBOURS + 1) & (F.col("unlike") > 1)).drop("unlike")
    sizes = settle(sizes.join(dense, region), "dense")
    lane = F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / BLOCK))
    block = F.when(F.col("m") > BLOCK, F.xxhash64("component", lane)).otherwise(F.pmod(F.xxhash64("component"), F.ceil(F.col("n") / BLOCK)))
    met = rows.join(sizes, [*region, "component"]).select(*region, block.alias("block"), "node", "component")
    met = met.join(classes.select("node", "signature"), "node")
    inside = F.collect_list(F.struct("node", "component", "signature")).alias("rows")
    blocks = settle(met.groupBy(*region, "block").agg(F.min("component").alias("low"), F.max("component").alias("high"), inside), "blocks")
    one, two = (blocks.select(*region, F.col("block").alias(n), F.col("low").alias(f"low_{n}"), F.col("high").alias(f"high_{n}")) for n in "xy")
    unlike = F.least("low_x", "low_y") != F.greatest("high_x", "high_y")
    both = settle(one.join(two, region).where((F.col("x") <= F.col("y")) & unlike).select(*region, "x", "y"), "both")
    for name in "xy":
        both = both.join(blocks.select(*region, F.col("block").alias(name), F.col("rows").alias(f"rows_{name}")), [*region, name])
    tied = (F.col("x") == F.col("y")).alias("tied")

    def run(batches):
        for batch in batches:
            for k, (tree, tied) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                sides = [batch.column(c)[k].values for c in ((2,) if tied else (2, 3))]
                nodes, known, labels = ([v for side in sides for v in side.field(f).to_pylist()] for f in range(3))
                signatures = np.frombuffer(b"".join(labels), np.uint16).reshape(-1, TREES * DEPTH)
                found = [(nodes[n], nodes[p]) for n, p in _tied(signatures, known, tree, 0 if tied else len(sides[0]), least)]
                a, b = zip(*found) if found else ((), ())
                kind = sides[0].field(0).type
                yield pa.record_batch([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    kind = rows.schema["node"].dataType.simpleString()
    return both.select("tree", tied, "rows_x", "rows_y").mapInArrow(run, f"a {kind}, b {kind}")


def _region_links(docs: DataFrame, rows: DataFrame, classes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """a, b: confirmed links that join all similar classes that share a region.

    The classes that candidate links join form clusters.  Their full sets meet in blocks
    of bounded bytes; a task compares two blocks, confirms on the sets what is
    not in one tree yet, the likeliest partners first, and tells the links that joined something.
    """
    kind = rows.schema["node"].dataType.simpleString()
    candidates = settle(_candidate_links(rows, classes, agreeing(threshold)), "candidates")
    if candidates.isEmpty():
        return candidates
    known = rows.select("node", "component").distinct()
    # classes of one component are in one cluster
    held = known.join(_nodes(candidates), "node", "left_semi").where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    clusters = settle(components(candidates.unionAll(held), "clusters").withColumnRenamed("component", "cluster"), "clusters")
    members = clusters.join(known, "node").join(classes.select("node", "digest", "signature"), "node")
    sets = settle(_sets(docs, members.select("node", "digest")), "cluster-sets")
    members = members.join(sets, "node").select("cluster", "node", "component", "signature", "codes")
    weighed = members.groupBy("cluster").agg(F.sum(F.length("codes") + F.length("signature")).alias("bytes"))
    members = members.join(weighed.select("cluster", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("blocks")), "cluster")
    members = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = members.select("cluster", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "component", "signature", "codes")
    met = met.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "own")
    part, whole = threshold
    least = agreeing(threshold)

    def links(x: int, y: int, rows: list[tuple]) -> list[tuple]:
        owns, nodes, known, labels, sets = zip(*rows)
        signatures = np.frombuffer(b"".join(labels), np.uint16).reshape(-1, TREES * DEPTH)
        sets = [np.frombuffer(s, np.uint64) for s in sets]
        trees = np.unique(np.array(known, object), return_inverse=True)[1]
        split, found = 0 if x == y else owns.count(x), []
        if x != y and not 0 < split < len(owns):
            return []
        for n, partners, agreement, _ in _agreeing_pairs(signatures, lambda row, start: trees[start:] != trees[row], split, least):
            one, partners = sets[n], partners[np.argsort(-agreement, kind="stable")]
            while len(partners):
                two = sets[partners[0]]
                short, long = sorted((len(one), len(two)))
                if whole * short >= part * long:
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    if whole * both >= part * (short + long - both):
                        found.append((nodes[n], nodes[partners[0]]))
                        trees[trees == trees[partners[0]]] = trees[n]
                partners = partners[1:][trees[partners[1:]] != trees[n]]
        return found

    def run(batches):
        at, held, node = None, [], None

        def told():
            found = links(at[1], at[2], held)
            a, b = zip(*found) if found else ((), ())
            return pa.record_batch([pa.array(a, node), pa.array(b, node)], ["a", "b"])

        for batch in slices(batches):
            node = batch.schema.field("node").type
            for *key, own, n, component, signature, codes in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    if held:
                        yield told()
                    at, held = key, []
                held.append((own, n, component, signature, codes))
        if held:
            yield told()

    return settle(met.mapInArrow(run, f"a {kind}, b {kind}"), "region-links")


def _hub_pairs(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Pairs a < b of classes with the hubs of their regions, of unlike components."""
    region = ["tree", F.substring("label", 1, 2 * PREFIX).alias("prefix")]
    weighed = rows.join(weights, "node").select(*region, "node", "component", "weight")
    best = Window.partitionBy("tree", "prefix").orderBy(F.desc("weight"), "node")
    hubs = weighed.withColumn("place", F.row_number().over(best)).where(F.col("place") <= HUBS)
    # at most HUBS in a list, so that a class meets each of its regions once
    hubs = hubs.groupBy("tree", "prefix").agg(F.collect_list(F.struct(F.col("node").alias("hub"), F.col("component").alias("other"))).alias("hubs"))
    met = rows.select(*region, "node", "component").join(settle(hubs, "hubs"), ["tree", "prefix"])
    unlike = F.filter("hubs", lambda hub: hub["other"] != F.col("component"))
    met = met.select("node", F.explode(unlike).alias("h")).select("node", "h.hub")
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _nothing(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0].select("a", "b")
    for more in frames[1:]:
        whole = whole.unionAll(more.select("a", "b"))
    return whole


def keep_one(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows, all columns, of one document of each group: the smallest id."""
    found = near_duplicates(docs, threshold)
    dropped = settle(found.where(~F.col("kept")).select(F.col("doc_id").alias("dropped_id")).distinct(), "dropped")
    return docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")
