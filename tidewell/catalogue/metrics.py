"""Recurring-revenue metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.catalogue.base import Tables, query
from tidewell.operators import metrics as m
from tidewell.operators import models, sketches
from tidewell.operators.quality import union_all
from tidewell.session import settle

_SUBSCRIPTIONS = """select o_orderkey as subscription_id, o_custkey as user_id, o_orderpriority as tier,
  case o_orderstatus when 'F' then 'cancelled' when 'O' then 'active' else 'trial' end as status,
  cast(floor(o_totalprice) / 100 as decimal(10,2)) as current_mrr, cast(o_orderdate as date) as start_date,
  case when o_orderstatus = 'F' then cast(o_orderdate + DAYS(o_custkey % 200) as date) end as end_date from {orders}"""


@query("mrr", f"select sum(current_mrr)::double as mrr from ({_SUBSCRIPTIONS}) where status = 'active'")
def mrr(t: Tables):
    return m.recurring_revenue(t.sql(_SUBSCRIPTIONS)).select("mrr")


@query(
    "arr",
    f"""select tier, (12 * sum(current_mrr))::double as arr, sum(current_mrr)::double as mrr,
        count(*) as active_subscriptions from ({_SUBSCRIPTIONS}) where status = 'active' group by tier""",
)
def arr(t: Tables):
    return m.recurring_revenue(t.sql(_SUBSCRIPTIONS), ["tier"])


_MONTHS = f"""with s as ({_SUBSCRIPTIONS}),
span as (select date_trunc('month', min(start_date)) as a,
  greatest(date_trunc('month', max(start_date)), date_trunc('month', max(end_date))) as b from s),
months as (select unnest(generate_series(a, b, interval 1 month))::date as month from span),
running as (select month, (select count(*) from s where start_date < month and (end_date is null or end_date >= month))
    as active_at_start,
  (select count(*) from s where date_trunc('month', end_date) = month and start_date < month) as churned from months)
select month::varchar as month, active_at_start, churned,
  case when active_at_start > 0 then churned / active_at_start end as churn_rate,
  case when active_at_start > 0 then 1 - churned / active_at_start end as retention_rate from running"""


@query("churn_rate", f"select month, active_at_start, churned, churn_rate from ({_MONTHS})")
def churn_rate(t: Tables):
    return m.churn_by_month(t.sql(_SUBSCRIPTIONS)).drop("retention_rate")


@query("retention", f"select month, retention_rate from ({_MONTHS})")
def retention(t: Tables):
    return m.churn_by_month(t.sql(_SUBSCRIPTIONS)).select("month", "retention_rate")


@query(
    "ltv",
    f"""select arpu, arpu / 0.05::double as ltv from (select sum(current_mrr)::double / count(distinct user_id) as arpu
        from ({_SUBSCRIPTIONS}) where status = 'active')""",
)
def ltv(t: Tables):
    return m.lifetime_value(t.sql(_SUBSCRIPTIONS), 0.05)


_PAID = """select o_orderkey as subscription_id, o_custkey as user_id, cast(o_totalprice as decimal(10,2)) as amount,
  o_orderdate as payment_date, case o_orderstatus when 'F' then 'failed' else 'success' end as payment_status from {orders}"""


@query(
    "nrr",
    f"""with u as (select user_id, date_trunc('month', payment_date)::date as month, sum(amount) as mrr
          from ({_PAID}) group by 1, 2)
        select (b.month + interval 1 month)::date::varchar as month, sum(b.mrr)::double as starting_mrr,
          coalesce(sum(n.mrr), 0)::double as retained_mrr, count(*) as cohort_users, count(n.user_id) as retained_users,
          coalesce(sum(n.mrr), 0)::double / sum(b.mrr)::double as nrr
        from u b left join u n on n.user_id = b.user_id and n.month = b.month + interval 1 month group by 1""",
)
def nrr(t: Tables):
    return m.net_retention(m.monthly_user_revenue(t.sql(_PAID), "user_id", "amount", "payment_date"))


_REVENUE = f"""select date_trunc('month', payment_date)::date as month, sum(amount)::double as revenue,
  count(distinct subscription_id) as subscribers from ({_PAID}) where payment_status = 'success' group by 1"""


def _monthly(t: Tables):
    return m.revenue(t.sql(_PAID), [F.trunc("payment_date", "month").alias("month")])


@query("revenue", f"select month::varchar as month, revenue, subscribers from ({_REVENUE})")
def revenue(t: Tables):
    return _monthly(t)


@query(
    "revenue_trend",
    f"""select round(slope, 4) as slope, round(next_value, 2) as next_value, months from (
        select regr_slope(revenue, x) as slope, count(*) as months,
          regr_intercept(revenue, x) + regr_slope(revenue, x) * (max(x) + 1) as next_value
        from (select revenue, (year(month) * 12 + month(month))::double as x from ({_REVENUE})))""",
)
def revenue_trend(t: Tables):
    line = m.revenue_trend(_monthly(t))
    return line.select(
        F.round("slope", 4).alias("slope"), F.round("next_value", 2).alias("next_value"), "months"
    )


def _customer_features(t: Tables):
    """One row per customer, from orders aggregated before the join."""
    orders = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders"),
        F.avg("o_totalprice").alias("mean_price"),
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
    )
    return t.customer.join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey",
        "orders",
        "mean_price",
        "c_acctbal",
        (F.col("finished") > F.col("orders") / 3).cast("double").alias("has_left"),
    )


@query("churn_scores")
def churn_scores(t: Tables):
    customers = _customer_features(t)
    model = models.fit_churn(customers, ["orders", "mean_price", "c_acctbal"], "has_left")
    return models.churn_scores(model, customers)


@query(
    "churn_scores_facts",
    """select count(*) as customers, count(distinct c_custkey) as keys, sum(c_custkey)::bigint as key_sum, true as within_bounds
       from (select distinct c_custkey from orders join customer on o_custkey = c_custkey)""",
)
def churn_scores_facts(t: Tables):
    """Every customer with orders is scored once, between 0 and 1."""
    return churn_scores(t).agg(
        F.count("*").alias("customers"),
        F.countDistinct("c_custkey").alias("keys"),
        F.sum("c_custkey").alias("key_sum"),
        F.bool_and(F.col("churn_score").between(0, 1)).alias("within_bounds"),
    )


@query("customer_segments")
def customer_segments(t: Tables):
    return models.segments(_customer_features(t), ["orders", "mean_price", "c_acctbal"], 4)


@query(
    "customer_segments_facts",
    """select count(*) as customers, count(distinct c_custkey) as keys, sum(c_custkey)::bigint as key_sum, 4 as segments
       from (select distinct c_custkey from orders join customer on o_custkey = c_custkey)""",
)
def customer_segments_facts(t: Tables):
    """Every customer with orders is in one of the four segments, none of which is empty."""
    return customer_segments(t).agg(
        F.count("*").alias("customers"),
        F.countDistinct("c_custkey").alias("keys"),
        F.sum("c_custkey").alias("key_sum"),
        F.countDistinct("segment").cast("int").alias("segments"),
    )


_AS_OF = "date '2001-06-30'"
_STARTED = f"""select *, date_trunc('month', start_date)::date as cohort, case when end_date <= {_AS_OF} and end_date >= start_date then
  (year(end_date) - year(start_date)) * 12 + month(end_date) - month(start_date) end as lasted from ({_SUBSCRIPTIONS}) where start_date <= {_AS_OF}"""


@query(
    "retention_by_cohort",
    f"""with s as ({_STARTED}),
    c as (select cohort, count(*) as size, unnest(range(0, (2001 - year(cohort)) * 12 + 6 - month(cohort) + 1)) as age from s group by cohort)
    select c.cohort::varchar as cohort, c.age::int as age, size,
      (select count(*) from s where s.cohort = c.cohort and (lasted is null or lasted >= c.age)) as retained,
      (select count(*) from s where s.cohort = c.cohort and (lasted is null or lasted >= c.age)) / size as share from c""",
)
def retention_by_cohort(t: Tables):
    return m.retention_by_cohort(t.sql(_SUBSCRIPTIONS), F.expr(_AS_OF))


@query(
    "survival_curve",
    f"""with s as (select date_diff('day', start_date, case when end_date <= {_AS_OF} then greatest(end_date, start_date) else {_AS_OF} end) as age,
        coalesce(end_date <= {_AS_OF}, false) as over from ({_SUBSCRIPTIONS}) where start_date <= {_AS_OF}),
    d as (select age, count(*) filter (over) as ended, count(*) as n from s group by age),
    r as (select age, ended, sum(n) over (order by age desc) as at_risk from d),
    p as (select age, ended, at_risk, product(1 - ended / at_risk) over (order by age) as survival from r)
    select age::int as age, at_risk::bigint as at_risk, ended, round(survival, 9) as survival from p where ended > 0""",
)
def survival_curve(t: Tables):
    """Open subscriptions count as censored, not as ended."""
    return m.survival_curve(t.sql(_SUBSCRIPTIONS), F.expr(_AS_OF)).withColumn("survival", F.round("survival", 9))


_HELD_OUT = "('0x' || substr(md5(cast(c_custkey as varchar)), 1, 8))::bigint % 5 = 0"
_FEATURES = ["orders", "mean_price", "c_acctbal"]
_LEFT_SQL = """select c_custkey, count(*) as orders, avg(o_totalprice) as mean_price, any_value(c_acctbal) as c_acctbal,
  count(*) filter (o_orderstatus = 'F') > count(*) / 3 as has_left from orders join customer on o_custkey = c_custkey group by c_custkey"""


@query(
    "churn_evaluation",
    f"""select count(*) filter (not {_HELD_OUT}) as trained, count(*) filter ({_HELD_OUT}) as tested, 0 as in_both,
        count(*) filter ({_HELD_OUT} and has_left) as left_in_test, true as matrix_adds_up, true as within_bounds from ({_LEFT_SQL})""",
)
def churn_evaluation(t: Tables):
    """The model is judged on customers that it has not seen."""
    customers = _customer_features(t)
    scored, quality = models.evaluate_churn(customers, "c_custkey", _FEATURES, "has_left")
    train = customers.filter(~models.held_out("c_custkey"))
    counts = scored.agg(F.count("*").alias("tested"))
    sizes = train.agg(F.count("*").alias("trained"))
    both = train.join(scored, "c_custkey", "left_semi").agg(F.count("*").cast("int").alias("in_both"))
    facts = union_all([sizes, counts, both, quality])
    whole = facts.agg(*[F.max(c).alias(c) for c in facts.columns])
    sum_of = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    bounded = [F.coalesce(F.col(c).between(0, 1), F.lit(True)) for c in ("auc", "f1", "precision", "recall")]
    return whole.select(
        "trained", "tested", "in_both", (F.col("tp") + F.col("fn")).alias("left_in_test"), (sum_of == F.col("tested")).alias("matrix_adds_up"),
        (bounded[0] & bounded[1] & bounded[2] & bounded[3]).alias("within_bounds"),
    )


@query(
    "segment_evaluation",
    f"""select k::int as segments, (select count(*) from ({_LEFT_SQL}) where {_HELD_OUT}) as customers, true as within_bounds
        from (select unnest([2, 3, 4, 5]) as k)""",
)
def segment_evaluation(t: Tables):
    """Silhouettes of several numbers of segments, over customers held out of the fit."""
    found = models.evaluate_segments(_customer_features(t), "c_custkey", _FEATURES, [2, 3, 4, 5])
    fits = F.coalesce(F.col("silhouette").between(-1, 1), F.lit(True)) & (F.col("used") <= F.col("segments"))
    return found.select("segments", "customers", fits.alias("within_bounds"))


@query(
    "sketched_profile",
    """select count(*) as n, count(distinct user_id) as users, true as users_within_error, true as median_within_error,
       (select event_type from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-22' group by 1 order by count(*) desc, 1 limit 1) as most_frequent
       from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-22'""",
)
def sketched_profile(t: Tables):
    """Two weeks from the sketches of their days, against the rows themselves: three standard
    errors for distinct users, the rank error for the median."""
    events = t.events.withColumn("day", F.to_date("ts"))
    days = settle(sketches.daily_sketches(events, "day", ["user_id"], ["value"], ["event_type"]), "sketches")
    wanted = F.col("day").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-21").cast("date"))
    # one row of estimates
    told = sketches.estimates(sketches.merged_sketches(days.filter(wanted))).first()
    below, upto = (F.avg(which.cast("int")) for which in (F.col("value") < told["value_median"], F.col("value") <= told["value_median"]))
    users = F.countDistinct("user_id")
    error = F.abs(F.lit(told["user_id_distinct"]) - users) / users
    return events.filter(wanted).agg(
        F.lit(told["n"]).alias("n"),
        users.alias("users"),
        (error <= 3 * sketches.HLL_ERROR).alias("users_within_error"),
        ((below <= 0.5 + sketches.KLL_ERROR) & (upto >= 0.5 - sketches.KLL_ERROR)).alias("median_within_error"),
        F.lit(told["event_type_frequent"][0]["item"]).alias("most_frequent"),
    )
