"""Small documents with every awkward case, for all operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, route string, anchor string"


def awkward(seed=1, n=40):
    """Documents with nulls, empty and long texts, copies, repeated rows and clashing columns."""
    pick = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "Über", "niño", "12", "don't", "zeta,", "eta.\nTheta", "iota  kappa", "\tmu"]

    def text(size):
        return " ".join(pick.choice(words) + str(pick.randint(0, 30)) * pick.randint(0, 1) for _ in range(size))

    rows = [(k, text(pick.randint(1, 160)), pick.choice(["en", "de", None]), "s", 1) for k in range(n)]
    rows += [(100 + k, rows[pick.randint(0, 5)][1], "en", "s", 1) for k in range(10)]
    rows += [(200, None, "en", "s", 1), (201, "", "de", "s", 0), (202, " \n\t ", None, None, None)]
    rows += [(None, rows[2][1], "en", "s", 1), (None, None, None, None, None)]
    rows += [rows[7], rows[7], (8, "quite another text under one id", "en", "s", 1)]
    rows += [(300, text(6000), "en", "s", 1), (301, "same " * 900, "de", "s", 1), (302, "x" * 5000, "de", "s", 1)]
    return [(*r, "clash", "clash", "clash", "clash") for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(4)


def bag(rows):
    return sorted([tuple(r) for r in rows], key=repr)
