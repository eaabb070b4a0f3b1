import pytest
from conftest import physical, rows
from pyspark.sql import functions as F

from tidewell.operators import references as r

FACTS = [(1, 10), (2, 20), (3, None), (4, 99), (5, 10)]
KEYS = [(10,), (10,), (20,), (None,)]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(FACTS, "id int, fk int")


@pytest.fixture
def keys(spark):
    return spark.createDataFrame(KEYS, "ref int")


ON = {"fk": "ref"}


def test_semi_and_anti_conserve(facts, keys):
    assert rows(r.having_reference(facts, keys, ON), "id") == [(1,), (2,), (5,)]
    assert rows(r.lacking_reference(facts, keys, ON), "id") == [(3,), (4,)]


def test_marking_never_multiplies(facts, keys):
    marked = r.mark_reference(facts, keys, r.Reference("", ON, ""), "missing")
    assert rows(marked) == [(1, 10, False), (2, 20, False), (3, None, True), (4, 99, True), (5, 10, False)]


def test_optional_key_may_be_null(facts, keys):
    spec = r.Reference("", ON, "", optional=True)
    marked = r.mark_reference(facts, keys, spec, "missing")
    assert rows(marked.filter("missing"), "id") == [(4,)]
    assert rows(r.referenced(facts, keys, spec), "id") == [(1,), (2,), (3,), (5,)]


def test_roles_and_complement(spark, keys):
    df = spark.createDataFrame([(1, 10, 20), (2, 10, 99), (3, None, 20), (4, 99, 98)], "id int, a int, b int")
    assert rows(r.with_roles(df, keys, "ref", ["a", "b"]), "id") == [(1,)]
    assert rows(r.without_roles(df, keys, "ref", ["a", "b"]), "id") == [(2,), (3,), (4,)]


def test_split_has_reason(facts, keys):
    good, bad = r.reference_split(facts, keys, ON, "gone")
    assert good.count() + bad.count() == len(FACTS)
    assert {x.quarantine_reason for x in bad.collect()} == {"gone"}


def test_lookup_keeps_row_count(spark, facts):
    dim = spark.createDataFrame([(10, "x"), (20, "y")], "ref int, name string")
    assert rows(r.looked_up(facts, dim, ON, ["name"], "left"), "id", "name") == [
        (1, "x"), (2, "y"), (3, None), (4, None), (5, "x"),
    ]


@pytest.mark.parametrize("form", ["semi", "anti", "mark"])
def test_hot_key_is_split(spark, conf, form):
    """A third of the rows hold one key; AQE splits its partition."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="60000",
    )
    facts = spark.range(0, 120_000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("fk"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    keys = spark.range(0, 4000, 1, 4).select(F.col("id").alias("ref"))
    result = {
        "semi": lambda: r.having_reference(facts, keys, ON),
        "anti": lambda: r.lacking_reference(facts, keys, ON),
        "mark": lambda: r.mark_reference(facts, keys, r.Reference("", ON, ""), "m"),
    }[form]()
    total = result.agg(F.count("*").alias("n"), F.sum(F.length("text")))
    found = total.collect()[0].n
    missing = facts.filter("fk >= 4000").count()
    assert found == {"semi": 120_000 - missing, "anti": missing}.get(form, 120_000)
    assert "skew=true" in physical(total)
