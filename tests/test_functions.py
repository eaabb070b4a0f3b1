from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.functions import casting, dates, derived, subscription, text
from tidewell.operators import nested, quality


def value(spark, column, **given):
    df = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given))
    return df.select(column()).first()[0]


@pytest.mark.parametrize(
    "raw, dtype, expected",
    [(" 12 ", "int", 12), ("12x", "int", None), ("1.5", "int", None), (None, "int", None), ("yes", "boolean", True),
     ("maybe", "boolean", None), ("2024-02-30", "date", None), ("2024-02-29", "date", date(2024, 2, 29)),
     ("99999999999", "int", None)],
)
def test_lenient(spark, raw, dtype, expected):
    assert value(spark, lambda: casting.lenient("x", dtype), x=raw) == expected


def test_text(spark):
    assert value(spark, lambda: text.snaked("x"), x="  Free \t Trial ") in ("free_trial", "free_trial_")
    assert value(spark, lambda: text.titled("x"), x=" sOUTH kOREA") == "South Korea"
    assert value(spark, lambda: text.ticket_category("x"), x="A Payment bug") == "technical"
    assert value(spark, lambda: text.ticket_category("x"), x="REFUND and cancel") == "billing"
    assert value(spark, lambda: text.ticket_category("x"), x="please Cancel") == "cancellation"
    assert value(spark, lambda: text.ticket_category("x"), x="dark mode") == "feature_request"
    assert value(spark, lambda: text.is_meaningless("x"), x=" N/A ") is True
    assert value(spark, lambda: text.is_meaningless("x"), x=None) is True


def test_bytes_and_nan(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb\xc3\xa9"), float("nan")), (None, 1.0)], "b binary, d double")
    assert rows(df.select(casting.utf8_text("b"), casting.number_or_null("d"))) == [("abé", None), (None, 1.0)]


def test_replacement_characters_in_the_text_stay(spark):
    df = spark.createDataFrame([(bytearray("a\ufffdb".encode() + b"\xff"),)], "b binary")
    assert df.select(casting.utf8_text("b")).first()[0] == "a\ufffdb"


def test_blank_to_null(spark):
    df = spark.createDataFrame([("", " ", 1), ("a", None, 2)], "x string, y string, n int")
    assert rows(casting.blanks_to_null(df)) == [("a", None, 2), (None, None, 1)]


def test_dates(spark):
    df = spark.sql("select date'2024-01-31' s, date'2024-01-01' e, cast(null as date) n")
    got = df.select(
        dates.end_not_before("s", "e"), dates.end_not_before("s", "n"), dates.end_or_default("s", "n"),
        dates.end_or_default("s", "n", 0), dates.span_days("s", "e"), dates.in_month("s", date(2024, 1, 9)),
        dates.in_month("s", date(2024, 2, 9)), dates.on_day("s", date(2024, 1, 31)),
    ).first()
    assert tuple(got) == (date(2024, 1, 31), None, date(2025, 1, 30), date(2024, 1, 31), 1, True, False, True)


def test_money(spark):
    df = spark.sql("select cast(120 as decimal(10,2)) p, 'Annual' a, 'MONTHLY' m")
    price = F.col("p")
    got = df.select(
        subscription.monthly_price(price, F.col("a"), F.lit(False)).cast("string"),
        subscription.monthly_price(price, F.col("m"), F.lit(False)).cast("string"),
        subscription.monthly_price(price, F.col("a"), F.lit(True)).cast("double"),
        subscription.charge_amount(price, F.col("a")).cast("double"),
    ).first()
    assert [float(x) for x in got] == [10.0, 120.0, 0.0, 1440.0]
    assert value(spark, lambda: subscription.exchange_rate("c"), c="jpy") is None
    assert value(spark, lambda: subscription.exchange_rate("c"), c=None) is None


@pytest.mark.parametrize(
    "status, end, expected",
    [("active", None, "No"), ("active", "2024-01-01", "Yes"), ("active", "2024-01-02", "No"), ("Canceled", None, "Yes"),
     ("expired", None, "Yes"), (None, None, "No")],
)
def test_churn(spark, status, end, expected):
    def flag():
        return subscription.has_churned("s", "e", F.lit(date(2024, 1, 1)))

    assert value(spark, flag, s=status, e=end) == expected


def test_flatten_is_recursive(spark):
    df = spark.sql("select 1 a, struct(2 x, struct(3 y, array(4) z) i) s")
    flat = nested.flatten_structs(df)
    assert flat.columns == ["a", "s_x", "s_i_y", "s_i_z"] and tuple(flat.first()) == (1, 2, 3, [4])


def test_infer_json(spark):
    docs = ['{"a":1,"b":{"c":"x"}}', '{"a":2.5,"d":null}', "{broken", None]
    df = spark.createDataFrame([(d,) for d in docs], "data string")
    schema = nested.infer_json_schema(df, "data")
    parsed = nested.flatten_structs(nested.parse_json(df, "data", schema))
    assert {"a", "b_c"} <= set(parsed.columns) and parsed.count() == len(docs)
    assert rows(parsed, "b_c") == [("x",), (None,), (None,), (None,)]


def test_split_sends_nulls_to_quarantine(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None), (99, "z"), (None, None)], "n int, s string")
    rules = [quality.within("n", 0, 9), quality.one_of("s", ["a", "it's"], "bad s")]
    good, bad = quality.split(df, rules)
    assert rows(good) == [(1, "a")]
    assert rows(bad, "validation_error") == [
        ("bad s",), ("n outside 0-9",), ("n outside 0-9; bad s",), ("n outside 0-9; bad s",),
    ]
    flags = quality.with_flags(df, rules)
    assert flags.filter("is_valid_record").count() == 1
    assert flags.filter("is_valid_record is null").count() == 0


def test_rules_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("cast(id as int) n", "'a' s", "id unused").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = quality.valid_rows(df, [quality.within("n", 1, 5), quality.required("s")]).select("n")
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n,1)" in text_plan and "LessThanOrEqual(n,5)" in text_plan
    assert "unused" not in text_plan


def test_derived_columns_resolve(spark):
    as_of = F.lit(date(2024, 6, 1))
    users = spark.sql("select timestamp'2023-06-15' created_at, 30 age, 'a@b' email")
    got = users.withColumns(derived.user_columns(as_of)).first()
    assert (got.user_tenure_months, got.age_group, got.is_valid_email) == (11, "25-34", False)
    licence = spark.sql("select 30 max_seats, date'2024-01-01' issued_date, date'2024-07-01' expiry_date")
    got = licence.withColumns(derived.licence_columns(as_of)).first()
    assert (got.seat_tier, got.license_active_flag, got.days_to_expiry) == ("medium", True, 30)
