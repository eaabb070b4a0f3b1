"""Hand-made rows through the ten entity plans: every rule, every edge."""

from datetime import date, datetime

import pytest
from conftest import physical, rows
from pyspark.sql import functions as F

from tidewell.operators import dedup, upsert
from tidewell.operators.nested import infer_json_schema
from tidewell.plans import jobs
from tidewell.plans.entity import SUPERSEDED
from tidewell.plans.entities import ENTITIES, strict, usage_events_plan, users_plan
from tidewell.plans.steps import Context, Latest, unmarked

D1, D2, D3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
I1, I2, I3 = "2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"


class Case:
    """Raw rows as (expected reason or '', values); unnamed columns take the base."""

    def __init__(self, base, cases, refs=None, key="key"):
        self.base, self.cases, self.refs = base, cases, refs or {}

    def raw(self, spark):
        names = list(self.base)
        data = [tuple({**self.base, **change}[n] for n in names) for _, change in self.cases]
        schema = ", ".join(f"`{n}` string" for n in names)
        return spark.createDataFrame(data, schema)

    def context(self, spark):
        tables = {
            name: spark.createDataFrame([(k,) for k in keys], f"{column} bigint")
            for name, (column, keys) in self.refs.items()
        }
        return Context(tables, date(2024, 6, 1))


USERS = ("user_id", [1, 2, 3])
SUBSCRIPTIONS = ("subscription_id", [1, 2, 3])

CASES = {
    "products": Case(
        dict(id="9", product_id="1", product_name=" Name ", category="Streaming", created_at=D1, ingest_time=I1,
             source_identifier="s", batch_id="b"),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate product_id", dict()),
            ("", dict(created_at=D2)),
            ("product_id is null", dict(product_id="x")),
            ("product_name is null; category is null", dict(product_id="3", product_name=None, category=None)),
            ("ingest_time is null", dict(product_id="4", ingest_time="soon")),
            ("", dict(product_id="5", created_at=None)),
        ],
    ),
    "users": Case(
        dict(id="9", user_id="1", first_name=" A ", last_name="B ", email=" X@Y.Z ", country=" viet nam", age="30",
             gender=" Male", acquisition_channel="PAID ", is_enterprise="true", created_at=D1, ingest_time=I1,
             source_identifier="s", batch_id="b"),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate user_id", dict()),
            ("", dict(created_at=D2, country=" south KOREA ")),
            ("user_id is null", dict(user_id="one")),
            ("created_at is null", dict(user_id="2", created_at="31/12/2024")),
            ("user_id is null; created_at is null", dict(user_id=None, created_at=None)),
            *[(("" if ok else "age outside 18-100"), dict(user_id=f"{n}", age=age))
              for n, age, ok in ((10, "17", 0), (11, "18", 1), (12, "100", 1), (13, "101", 0), (14, None, 0), (15, "x", 0))],
            ("invalid gender", dict(user_id="20", gender="robot")),
            ("invalid gender", dict(user_id="21", gender=None)),
            ("invalid acquisition_channel", dict(user_id="22", acquisition_channel="tv")),
            ("invalid acquisition_channel", dict(user_id="23", acquisition_channel=None)),
            ("invalid is_enterprise", dict(user_id="24", is_enterprise="maybe")),
            ("", dict(user_id="25", is_enterprise="no", country=None)),
            ("age outside 18-100", dict(user_id="26", age="5", gender="robot")),
        ],
    ),
    "plans": Case(
        dict(id="7", plan_id="1", product_id="1", tier="basic", billing_cycle="Monthly", price="9.994", currency="usd",
             created_at=D1, ingest_time=I1, source_identifier="s", batch_id="b"),
        [
            ("", dict(ingest_time=I2, tier="Free   trial")),
            ("duplicate plan_id", dict()),
            ("", dict(created_at=D2)),
            ("invalid tier; invalid price", dict(plan_id="2", tier="Gold", price="-1")),
            ("plan_id is null; product_id is null; invalid tier; invalid billing_cycle; invalid currency; "
             "invalid price; created_at is null",
             dict(plan_id=None, product_id="x", tier=None, billing_cycle="weekly", currency=None, price=None, created_at="?")),
            ("product_id not found in silver products", dict(plan_id="3", product_id="5")),
            ("", dict(plan_id="4", price="0", tier="ENTERPRISE", billing_cycle=" annual ", currency="vnd")),
            # an invalid row does not supersede a valid one
            ("invalid currency", dict(plan_id="4", ingest_time=I3, currency="JPY")),
        ],
        {"products": ("product_id", [1])},
    ),
    "subscriptions": Case(
        dict(id="9", subscription_id="1", user_id="1", plan_id="1", start_date="2024-03-01", end_date=None, status="Active ",
             current_mrr="10.50", created_at=D1, ingest_time=I1, source_identifier="s", batch_id="b"),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate subscription_id", dict()),
            ("", dict(created_at=D2, status="cancelled")),
            ("subscription_id is null", dict(subscription_id="x")),
            ("user_id is null; status is null", dict(subscription_id="2", user_id=None, status=None)),
            ("plan_id is null; start_date is null", dict(subscription_id="3", plan_id="p", start_date="soon")),
            ("invalid status", dict(subscription_id="4", status="paused")),
            ("user_id not found in silver users", dict(subscription_id="5", user_id="44")),
            ("end_date before start_date", dict(subscription_id="6", end_date="2024-02-29")),
            ("", dict(subscription_id="7", end_date="2024-03-01")),
            ("", dict(subscription_id="8", end_date="2024-03-02", status="trial", current_mrr="0")),
            ("current_mrr does not fit status", dict(subscription_id="9", status="trial", current_mrr="1")),
            ("current_mrr does not fit status", dict(subscription_id="10", current_mrr="0")),
            ("current_mrr does not fit status", dict(subscription_id="11", current_mrr=None)),
        ],
        {"users": USERS},
    ),
    "subscription_changes": Case(
        dict(change_id="1", subscription_id="1", old_plan_id="1", new_plan_id="2", change_type=" Upgrade", change_date=D1,
             ingest_time=I1),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate change_id", dict()),
            ("", dict(change_date=D2, change_type="downgrade")),
            ("old_plan_id is null; change_date is null", dict(change_id="2", old_plan_id="x", change_date="?")),
            ("invalid change_type", dict(change_id="3", change_type="switch")),
            ("old_plan_id not found in silver plans", dict(change_id="4", old_plan_id="9")),
            ("old_plan_id not found in silver plans; new_plan_id not found in silver plans",
             dict(change_id="5", old_plan_id="9", new_plan_id="8")),
            ("change_id is null", dict(change_id="x")),
        ],
        {"plans": ("plan_id", [1, 2])},
    ),
    "payments": Case(
        dict(id="9", payment_id="1", subscription_id="1", amount="10.00", currency=" eur", payment_status="Success",
             payment_date=D1, payment_method=" PayPal ", ingest_time=I1, created_at=D1, source_identifier="s", batch_id="b"),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate payment_id", dict()),
            ("", dict(payment_date=D2)),
            ("payment_id is null", dict(payment_id="x")),
            ("Invalid payment_status; Invalid currency; Invalid payment_method",
             dict(payment_id="2", payment_status=None, currency="JPY", payment_method="cash")),
            ("subscription_id not found in silver subscriptions", dict(payment_id="3", subscription_id="77")),
            ("subscription_id not found in silver subscriptions", dict(payment_id="4", subscription_id=None)),
            ("", dict(payment_id="5", currency="VND", amount="n/a", payment_status="refunded")),
        ],
        {"subscriptions": SUBSCRIPTIONS},
    ),
    "license_keys": Case(
        dict(license_id="1", subscription_id="1", max_seats="5", issued_date="2024-01-01", expiry_date="2024-07-01",
             ingest_time=I1, batch_id="b", source_identifier="s"),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate license_id", dict()),
            ("", dict(issued_date="2024-01-02")),
            ("license_id is null", dict(license_id="x")),
            ("issued_date is null; expiry_date is null", dict(license_id="2", issued_date="n/a", expiry_date=None)),
            ("subscription_id not found in silver_subscriptions", dict(license_id="3", subscription_id="9")),
            *[(("" if ok else "max_seats outside 5-500"), dict(license_id=f"{n}", max_seats=seats))
              for n, seats, ok in ((10, "4", 0), (11, "5", 1), (12, "500", 1), (13, "501", 0), (14, None, 0))],
            ("expiry_date before issued_date", dict(license_id="20", expiry_date="2024-01-01")),
            ("expiry_date before issued_date", dict(license_id="21", expiry_date="2023-01-01")),
        ],
        {"subscriptions": SUBSCRIPTIONS},
    ),
    "license_allocations": Case(
        dict(allocation_id="1", license_id="1", seat_number="1", status=" ACTIVE", allocation_date=D1, ingest_time=I1),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate allocation_id", dict()),
            ("", dict(allocation_date=D2, status="deactivated")),
            ("allocation_id is null; invalid status", dict(allocation_id="x", status=None)),
            ("license_id not found in silver licenses", dict(allocation_id="2", license_id="9")),
            ("license_id not found in silver licenses; seat_number outside 1-550",
             dict(allocation_id="3", license_id="9", seat_number="551")),
            *[(("" if ok else "seat_number outside 1-550"), dict(allocation_id=f"{n}", seat_number=seat))
              for n, seat, ok in ((10, "0", 0), (11, "1", 1), (12, "550", 1), (13, "551", 0), (14, None, 0))],
            ("invalid status", dict(allocation_id="20", status="paused")),
        ],
        {"license_keys": ("license_id", [1])},
    ),
    "support_tickets": Case(
        dict(ticket_id="1", user_id="1", category=" Billing", description=" text ", created_at=D1, ingest_time=I1),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate ticket_id", dict()),
            ("", dict(created_at=D2)),
            ("ticket_id is null; user_id is null; created_at is null; invalid category",
             dict(ticket_id=None, user_id="x", created_at="malformed", category=None)),
            ("invalid category", dict(ticket_id="2", category="praise")),
            ("user_id not found in silver users", dict(ticket_id="3", user_id="99")),
            ("user_id not found in silver users", dict(ticket_id="3", user_id="98", created_at=D3)),
        ],
        {"users": USERS},
    ),
    "usage_events": Case(
        dict(id="1", data='{"event_id":"e1","user_id":1,"subscription_id":1,"event_timestamp":"2024-01-01T10:00:00",'
             '"event_properties":{"duration_sec":10,"referrer":"ads"},"created_at":"c"}',
             created_at=D1, processed="true", ingest_time=I1),
        [
            ("", dict(ingest_time=I2)),
            ("duplicate event_id", dict()),
            ("event_id is null", dict(data="{broken")),
            ("event_id is null", dict(data=None, ingest_time=I2)),
            ("", dict(data='{"event_id":"e2","user_id":2,"extra":[1]}')),
            ("user_id not found in silver users", dict(data='{"event_id":"e3"}')),
            ("user_id not found in silver users; subscription_id not found in silver subscriptions",
             dict(data='{"event_id":"e4","user_id":50,"subscription_id":60}')),
            ("subscription_id not found in silver subscriptions",
             dict(data='{"event_id":"e5","user_id":1,"subscription_id":60}')),
        ],
        {"users": USERS, "subscriptions": SUBSCRIPTIONS},
    ),
}


@pytest.mark.parametrize("name", list(ENTITIES))
def test_reasons(spark, name):
    case, plan = CASES[name], ENTITIES[name]
    raw = case.raw(spark)
    audited = plan.audited(raw, case.context(spark))
    assert audited.count() == raw.count(), "every row stays on one side"
    found = [r.reason for r in plan.rejected_rows(audited).collect()]
    reasons = sorted(r for r in found if r != SUPERSEDED)
    assert reasons == sorted(reason for reason, _ in case.cases if reason)
    older = found.count(SUPERSEDED)
    assert plan.accepted(audited).count() + older == sum(not reason for reason, _ in case.cases)


@pytest.mark.parametrize("name", list(ENTITIES))
def test_both_readings_agree(spark, name):
    case, plan = CASES[name], ENTITIES[name]
    raw, context = case.raw(spark), case.context(spark)
    curated = plan.curated(raw, context)
    assert curated.columns[: len(plan.columns)] == list(plan.columns)
    assert rows(plan.batch(raw, context)) == rows(plan.accepted(plan.audited(raw, context)))


@pytest.mark.parametrize("name", list(ENTITIES))
def test_batch_upsert_and_report(spark, name):
    case, plan = CASES[name], ENTITIES[name]
    raw, context = case.raw(spark), case.context(spark)
    audited = plan.audited(raw, context)
    batch = plan.accepted(audited)
    assert batch.select(*plan.merge_keys).distinct().count() == batch.count()
    assert rows(plan.merged(plan.merged(None, batch), batch)) == rows(batch)
    report = {r.measure: r.row_count for r in plan.report(audited).collect()}
    assert report["accepted rows"] + report["rejected rows"] == raw.count()
    envelope = plan.quarantine(audited, "b1")
    assert envelope.columns == ["entity", "rule", "reason", "payload", "batch_id"]
    assert envelope.filter(F.col("payload").startswith("{")).count() == report["rejected rows"]


def one(spark, name, **where):
    case, plan = CASES[name], ENTITIES[name]
    found = plan.batch(case.raw(spark), case.context(spark))
    for column, value in where.items():
        found = found.filter(F.col(column) == value)
    return found.collect()[0]


def test_user_values(spark):
    user = one(spark, "users", user_id=1)
    assert (user.first_name, user.email, user.gender, user.acquisition_channel) == ("A", "x@y.z", "male", "paid")
    assert (user.country, user.is_valid_country) == ("South Korea", True)
    assert one(spark, "users", user_id=11).country == "Other"
    assert one(spark, "users", user_id=25).is_valid_country is None


def test_country_aliases_are_optional(spark):
    case = Case(CASES["users"].base, [("", dict(country="US"))])
    aliased = users_plan({"Us": "United States"})
    assert ENTITIES["users"].curated(case.raw(spark), Context()).first().country == "Other"
    assert aliased.curated(case.raw(spark), Context()).first().country == "United States"


def test_plan_values(spark):
    plan = one(spark, "plans", plan_id=4)
    assert (plan.tier, plan.billing_cycle, plan.currency) == ("Enterprise", "annual", "VND")
    assert str(one(spark, "plans", plan_id=1).price) == "9.99"


def test_subscription_values(spark):
    assert one(spark, "subscriptions", subscription_id=1).churn == "Yes"
    assert one(spark, "subscriptions", subscription_id=8).churn == "Yes"
    assert one(spark, "subscriptions", subscription_id=1).status == "cancelled"


def test_payment_values(spark):
    payment = one(spark, "payments", payment_id=1)
    assert [str(x) for x in (payment.exchange_rate, payment.amount_in_currency, payment.amount_usd)] == [
        "0.930000", "9.30", "10.75",
    ]
    assert str(payment.payment_date) == D2


def test_event_values(spark):
    event = one(spark, "usage_events", event_id="e1")
    assert (event.event_properties_duration_sec, event.event_properties_referrer) == (10, "ads")
    assert str(event.event_at) == "2024-01-01 10:00:00" and event.created_at == "c"
    assert str(event.created_at_event) == D1


STRICT = {
    "products": ([dict(), dict(product_id="2", category="Toys")], ["invalid category"]),
    "users": ([dict(), dict(user_id="2", email="nobody"), dict(user_id="3", email=None), dict(user_id="4", email="a@b.c d")],
              ["invalid email"] * 3),
    "subscriptions": ([dict(), dict(subscription_id="2", plan_id="9")], ["plan_id not found in silver plans"]),
    "subscription_changes": ([dict(), dict(change_id="2", subscription_id="9")],
                             ["subscription_id not found in silver subscriptions"]),
    "support_tickets": ([dict(), dict(ticket_id="2", description=" N/A"), dict(ticket_id="3", description=None)],
                        ["meaningless description"] * 2),
}


@pytest.mark.parametrize("name", list(STRICT))
def test_optional_checks(spark, name):
    changes, expected = STRICT[name]
    refs = {"users": USERS, "subscriptions": SUBSCRIPTIONS, "plans": ("plan_id", [1, 2])}
    case = Case(CASES[name].base, [("", c) for c in changes], refs)
    plan, context = strict(name), case.context(spark)
    audited = plan.audited(case.raw(spark), context)
    assert sorted(r.reason for r in plan.rejected_rows(audited).collect()) == expected
    assert plan.curated(case.raw(spark), context).count() == len(changes) - len(expected)
    assert ENTITIES[name].curated(case.raw(spark), context).count() == len(changes)


def test_events_with_an_inferred_schema(spark):
    payloads = ['{"event_id":"a","user_id":1,"colour":"red"}', '{"event_id":"b","user_id":2,"platform":"Web"}']
    case = Case(CASES["usage_events"].base, [("", dict(data=d)) for d in payloads], CASES["usage_events"].refs)
    raw = case.raw(spark)
    plan = usage_events_plan(infer_json_schema(raw, "data"))
    got = plan.curated(raw, case.context(spark))
    assert rows(got, "event_id", "platform", "colour", "session_id") == [("a", None, "red", None), ("b", "Web", None, None)]


def test_inferred_names_stay(spark):
    text = '{"VOIDED": null, "VARIANT_ID": 1, "VOID": 2, "nested": {"OBJECT": [null]}}'
    ddl = infer_json_schema(spark.createDataFrame([(text,)], "j string"), "j")
    parsed = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", ddl).alias("x")).select("x.*").first()
    assert (parsed.VOIDED, parsed.VARIANT_ID, parsed.VOID, parsed.nested.OBJECT) == (None, 1, 2, [None])


def test_repeated_reference_keys_multiply_no_rows(spark):
    case, plan = CASES["subscriptions"], ENTITIES["subscriptions"]
    context = case.context(spark)
    twice = Context({n: t.unionAll(t) for n, t in context.tables.items()}, context.as_of)
    assert plan.audited(case.raw(spark), twice).count() == case.raw(spark).count()


PAYMENT = "payment_id string, subscription_id long, amount double, currency string, payment_status string, payment_date timestamp, payment_method string, ingest_time timestamp"


def _payments(spark):
    """Keys that differ as text alone, null and hot ones, copies, older and broken rows."""
    at = [datetime(2024, 1, d) for d in (1, 2, 3)]
    made = [(str(k), k % 7, 1.0 + k, "usd", "success", at[k % 3], "paypal", at[k % 2]) for k in range(40)]
    made += [(f"0{k}", 1, 2.0, "usd", "success", at[2], "paypal", at[2]) for k in range(0, 40, 3)]
    made += [("7", 1, 3.0 + n % 5, "usd", "success" if n % 3 else "odd", at[n % 3], "paypal", at[n % 2]) for n in range(60)]
    made += [(None, 2, 4.0 + n % 4, "eur", "failed", at[n % 2], "paypal", at[0]) for n in range(50)]
    made += made[:10]
    return spark.createDataFrame(made, PAYMENT).repartition(5)


def test_audits_of_dealt_rows_equal_those_in_lanes(spark, monkeypatch):
    """Also where some keys are hot, which are then ranked in lanes."""
    plan = ENTITIES["payments"]
    context = Context({"subscriptions": spark.range(1, 5).toDF("subscription_id")})
    raw = _payments(spark)
    slow = unmarked(raw)
    for step in [*plan.steps, Latest(plan.batch_key, plan.newest, SUPERSEDED)]:
        slow = step.audit(slow, context)
    expected = rows(slow.select(*plan.columns, "_failed"))
    for least in (20_000, 5):
        monkeypatch.setattr(dedup, "HOT_ROWS", least)
        monkeypatch.setattr(dedup, "HOT_SHARE", 0)
        assert rows(plan.audited(raw, context).select(*plan.columns, "_failed")) == expected
    cold, hot = dedup.split_hot(raw, F.col("payment_id").cast("bigint"))
    assert {r["payment_id"] for r in hot.select("payment_id").distinct().collect()} == {"7", None}
    assert cold.count() + hot.count() == raw.count()


def test_an_audit_deals_its_rows_once(spark):
    """Rows meet no more for each choice of a latest row, twice each."""
    plan = ENTITIES["payments"]
    context = Context({"subscriptions": spark.range(1, 5).toDF("subscription_id")})
    found = physical(plan.audited(_payments(spark), context))
    assert "Exchange hashpartitioning(payment_id" in found and "REPARTITION_BY_COL" in found


def test_rows_that_were_reduced_are_not_reduced_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "reduce_batch", lambda *_: pytest.fail("accepted rows hold each key once"))
    context = Context({"subscriptions": spark.range(1, 5).toDF("subscription_id")})
    places = f"{tmp_path}/silver", f"{tmp_path}/quarantine"
    told = jobs.publish_accounted(spark, ENTITIES["payments"], _payments(spark), context, *places, "b0", buckets=2)
    assert told.merged.inserted == spark.read.parquet(places[0]).count() > 0
