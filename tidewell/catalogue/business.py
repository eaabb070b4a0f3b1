"""Business operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewell.catalogue.base import Tables, query
from tidewell.functions import derived, subscription
from tidewell.operators import business as b

_MONEY = """select o_orderkey, cast(o_totalprice as decimal(10,2)) as amount,
  case o_orderstatus when 'F' then ' eur' when 'O' then 'VND'
       else case when o_orderpriority = '5-LOW' then 'CHF' else 'GBP' end end as currency from {orders}"""


@query(
    "fx_convert",
    f"""select o_orderkey, rate::double as exchange_rate,
        cast(cast(amount as decimal(38,2)) * rate as decimal(18,2))::double as amount_in_currency,
        (2 * cast(amount * 100 as bigint) * 1000000 + cast(rate * 1000000 as bigint))
          // (2 * cast(rate * 1000000 as bigint)) / 100 as amount_usd
        from (select *, case upper(trim(currency)) when 'EUR' then 0.93::decimal(18,6) when 'VND' then 25500
              when 'GBP' then 0.8 end as rate from ({_MONEY}))""",
)
def fx_convert(t: Tables):
    rate = subscription.exchange_rate("currency")
    return t.sql(_MONEY).select(
        "o_orderkey",
        rate.alias("exchange_rate"),
        subscription.convert_from_usd("amount", rate).alias("amount_in_currency"),
        subscription.convert_to_usd("amount", rate).alias("amount_usd"),
    )


_PLANS = """select p_partkey, cast(p_retailprice as decimal(10,2)) as price,
  case when p_size > 25 then 'Annual' else 'monthly' end as billing_cycle, p_type = 'PROMO' as is_free from {part}"""


@query(
    "monthly_price",
    f"""select p_partkey, case when is_free then 0.0 when billing_cycle = 'monthly' then price::double
        else (cast(price * 100 as bigint) * 2 + 12) // 24 / 100 end as mrr from ({_PLANS})""",
)
def monthly_price(t: Tables):
    mrr = subscription.monthly_price(F.col("price"), F.col("billing_cycle"), F.col("is_free"))
    return t.sql(_PLANS).select("p_partkey", mrr.alias("mrr"))


@query(
    "charge_amount",
    f"""select p_partkey, (case when billing_cycle = 'Annual' then price * 12 else price end)::double as charge
        from ({_PLANS})""",
)
def charge_amount(t: Tables):
    charge = subscription.charge_amount(F.col("price"), F.col("billing_cycle"))
    return t.sql(_PLANS).select("p_partkey", charge.alias("charge"))


@query(
    "tier_canonical",
    """select p_partkey, case p_type when 'PROMO' then 'Free Trial' when 'STANDARD' then 'Standard'
       when 'ECONOMY' then 'Basic' else p_type end as tier,
       case p_type when 'PROMO' then 0 when 'ECONOMY' then 1 when 'STANDARD' then 2 end as tier_rank from part""",
)
def tier_canonical(t: Tables):
    spelt = F.when(F.col("p_type") == "PROMO", " Free  TRIAL").when(F.col("p_type") == "ECONOMY", "basic ")
    tiers = t.part.withColumn("tier", spelt.otherwise(F.col("p_type")))
    named = tiers.withColumn("tier", subscription.canonical_tier("tier"))
    return named.select("p_partkey", "tier", subscription.tier_rank("tier").alias("tier_rank"))


@query(
    "churn_flag",
    """select o_orderkey, case when o_orderstatus = 'F' or (o_orderpriority <> '5-LOW' and o_orderdate < timestamp '1997-01-02')
       then 'Yes' else 'No' end as churn from orders""",
)
def churn_flag(t: Tables):
    rows = t.sql(
        """select o_orderkey, case o_orderstatus when 'F' then 'Cancelled' else 'active' end as status,
           case when o_orderpriority <> '5-LOW' then cast(o_orderdate as date) end as end_date from {orders}"""
    )
    churn = subscription.has_churned("status", "end_date", F.lit(date(1997, 1, 1)))
    return rows.select("o_orderkey", churn.alias("churn"))


_SUBSCRIPTIONS = """select o_orderkey as subscription_id, o_custkey as user_id,
  case o_orderstatus when 'F' then 'cancelled' when 'O' then 'active' else 'trial' end as status from {orders}"""
_TICKETS = """select event_id as ticket_id, user_id, case event_type when 'error' then 'technical'
  when 'purchase' then 'billing' when 'signup' then 'cancellation' else 'feature_request' end as category from {events}"""
_PAYMENTS = """select l_orderkey as subscription_id, l_linenumber, case l_returnflag when 'R' then 'refunded'
  when 'A' then 'success' else case when l_tax > 0.06 then 'failed' else 'success' end end as payment_status from {lineitem}"""
_RISKY = f"select distinct user_id from ({_TICKETS}) where category in ('billing', 'cancellation')"
_PROBLEM = f"select distinct subscription_id from ({_PAYMENTS}) where payment_status in ('failed', 'refunded')"


@query("risky_users", _RISKY)
def risky_users(t: Tables):
    return b.risky_users(t.sql(_TICKETS))


@query("problem_subscriptions", _PROBLEM)
def problem_subscriptions(t: Tables):
    return b.problem_subscriptions(t.sql(_PAYMENTS))


@query(
    "risk_marking",
    f"""select *, user_id in ({_RISKY}) or subscription_id in ({_PROBLEM}) as at_risk from ({_SUBSCRIPTIONS})""",
)
def risk_marking(t: Tables):
    return b.mark_churn_risk(t.sql(_SUBSCRIPTIONS), t.sql(_TICKETS), t.sql(_PAYMENTS))


_GONE = f"select user_id from ({_SUBSCRIPTIONS}) where status = 'cancelled'"


@query("cancelled_users", f"select distinct user_id from ({_GONE})")
def cancelled_users(t: Tables):
    return b.cancelled_users(t.sql(_SUBSCRIPTIONS))


@query(
    "cancel_link",
    f"select * from ({_TICKETS}) where category = 'cancellation' and user_id in ({_GONE})",
)
def cancel_link(t: Tables):
    return b.linked_cancellations(t.sql(_TICKETS), t.sql(_SUBSCRIPTIONS))


_FEW_GONE = "select o_custkey as user_id, 'cancelled' as status from {orders} where o_totalprice > 400000"


@query(
    "cancel_link_missing",
    f"select * from ({_TICKETS}) where category = 'cancellation' and user_id not in (select user_id from ({_FEW_GONE}))",
)
def cancel_link_missing(t: Tables):
    return b.unlinked_cancellations(t.sql(_TICKETS), t.sql(_FEW_GONE))


@query(
    "seat_expand",
    """select l_orderkey, l_partkey, used, unnest(range(1, used + 1))::bigint as seat_number
       from (select l_orderkey, l_partkey, l_linenumber - 1 as used from lineitem)""",
)
def seat_expand(t: Tables):
    licences = t.lineitem.select("l_orderkey", "l_partkey", (F.col("l_linenumber") - 1).alias("used"))
    return b.expand_seats(licences, "used").withColumn("seat_number", F.col("seat_number").cast("long"))


_ALLOCATIONS = """select l_orderkey as allocation_id, l_partkey as license_id, cast(l_quantity as int) as seat_number,
  case l_linestatus when 'O' then 'active' else 'deactivated' end as status from {lineitem}"""
_LICENCES = "select p_partkey as license_id, p_size as max_seats from {part}"


@query(
    "seat_le_max",
    f"""select a.*, max_seats, seat_number between 1 and max_seats as seat_exists
        from ({_ALLOCATIONS}) a join ({_LICENCES}) l on a.license_id = l.license_id""",
)
def seat_le_max(t: Tables):
    return b.seats_in_range(t.sql(_ALLOCATIONS), t.sql(_LICENCES))


@query(
    "seat_utilisation",
    f"""select l.*, coalesce(n, 0) as active_seats, coalesce(n, 0) >= max_seats as is_fully_used from ({_LICENCES}) l
        left join (select license_id, count(distinct seat_number) as n from ({_ALLOCATIONS})
                   where status = 'active' group by 1) a on a.license_id = l.license_id""",
)
def seat_utilisation(t: Tables):
    return b.seat_utilisation(t.sql(_LICENCES), t.sql(_ALLOCATIONS))


@query(
    "session_rollup",
    """select user_id, cast(ts as date)::varchar as day, min(ts) filter (event_type = 'signup') as opened_at,
       max(ts) filter (event_type = 'purchase') as closed_at, min(ts) as first_event_at, max(ts) as last_event_at,
       count(*) as event_count, count(*) filter (event_type = 'signup') as opening_count,
       count(*) filter (event_type = 'purchase') as closing_count from events group by 1, 2""",
)
def session_rollup(t: Tables):
    """A user's day is the session; signup opens and purchase closes it."""
    events = t.events.withColumn("day", F.to_date("ts"))
    return b.sessions(events, ["user_id", "day"], "ts", opening="signup", closing="purchase")


@query(
    "derived_subscription_columns",
    """select o_orderkey, cast(d as varchar) as start_day,
       (date_diff('month', d, date '2002-01-31') - case when day(d) > 31 then 1 else 0 end)::int as subscription_tenure_months, year(d)::int as start_year, month(d)::int as start_month,
       date_diff('day', d, date '2002-01-31')::int as subscription_tenure_days,
       case when o_orderstatus = 'F' then month(d + 40)::int end as end_month, o_orderstatus = 'O' as is_active,
       o_orderstatus = 'P' as is_trial, o_orderstatus = 'F' as is_cancelled, o_totalprice > 100000 as is_paid
       from (select *, cast(o_orderdate as date) as d from orders)""",
)
def derived_subscription_columns(t: Tables):
    rows = t.sql(
        """select o_orderkey, cast(o_orderdate as date) as start_date,
           case when o_orderstatus = 'F' then cast(o_orderdate + DAYS(40) as date) end as end_date,
           case o_orderstatus when 'F' then 'cancelled' when 'O' then 'active' else 'trial' end as status,
           o_totalprice - 100000 as current_mrr from {orders}"""
    )
    columns = derived.subscription_columns(F.lit(date(2002, 1, 31)))
    columns["start_day"] = columns.pop("start_date")
    return rows.withColumns(columns).select("o_orderkey", *columns)


@query(
    "derived_licence_columns",
    """select o_orderkey, cast(d as varchar) as issued_day, year(d)::int as issued_year, month(d)::int as issued_month,
       case when seats <= 25 then 'small' when seats <= 100 then 'medium' else 'large' end as seat_tier,
       d + 365 > date '1999-01-01' as license_active_flag, date_diff('day', date '1999-01-01', d + 365)::int as days_to_expiry,
       date_trunc('month', d + 365)::date::varchar as expiry_month
       from (select *, cast(o_orderdate as date) as d, cast(floor(o_totalprice / 1000) as int) as seats from orders)""",
)
def derived_licence_columns(t: Tables):
    rows = t.sql(
        """select o_orderkey, cast(floor(o_totalprice / 1000) as int) as max_seats, cast(o_orderdate as date) as issued_date,
           cast(o_orderdate + DAYS(365) as date) as expiry_date from {orders}"""
    )
    columns = derived.licence_columns(F.lit(date(1999, 1, 1)))
    columns["issued_day"] = columns.pop("issued_date")
    return rows.withColumns(columns).select("o_orderkey", *columns)


@query(
    "derived_allocation_columns",
    """select l_orderkey, l_partkey, cast(l_shipdate as date)::varchar as allocation_day, year(l_shipdate)::int as allocation_year,
       month(l_shipdate)::int as allocation_month, l_linestatus = 'O' as is_active,
       case when l_linestatus = 'O' then 'assigned' else 'released' end as event_type,
       case when l_linestatus = 'O' then 1 else -1 end as seat_change from lineitem""",
)
def derived_allocation_columns(t: Tables):
    rows = t.sql(
        """select l_orderkey, l_partkey, l_shipdate as allocation_date,
           case l_linestatus when 'O' then 'active' else 'deactivated' end as status from {lineitem}"""
    )
    columns = derived.allocation_columns()
    columns["allocation_day"] = columns.pop("allocation_date")
    return rows.withColumns(columns).select("l_orderkey", "l_partkey", *columns)


@query(
    "derived_plan_columns",
    """select p_partkey, case when p_size > 25 then (cast(price * 100 as bigint) * 2 + 12) // 24 / 100 else price::double end
       as monthly_price_equivalent, price > 0 as is_paid, case p_type when 'PROMO' then 0 else 3 end as tier_rank,
       case when p_size > 25 then 1 else 12 end as billings_per_year
       , (date '2024-01-01' + (p_size % 90)::int)::varchar as created_day, year(date '2024-01-01' + (p_size % 90)::int)::int as created_year,
       month(date '2024-01-01' + (p_size % 90)::int)::int as created_month
       from (select *, cast(p_retailprice as decimal(18,2)) as price from part)""",
)
def derived_plan_columns(t: Tables):
    rows = t.sql(
        """select p_partkey, cast(p_retailprice as decimal(18,2)) as price, timestamp '2024-01-01 00:00:00' + DAYS(p_size % 90) as created_at,
           case when p_size > 25 then 'annual' else 'monthly' end as billing_cycle,
           case p_type when 'PROMO' then 'Free Trial' else 'Premium' end as tier from {part}"""
    )
    columns = derived.plan_columns()
    columns["created_day"] = columns.pop("created_date")
    return rows.select("p_partkey", *[v.alias(k) for k, v in columns.items()])


@query(
    "derived_ticket_columns",
    """select conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) as description_clean,
       length(trim(regexp_replace(text, '\\s+', ' ', 'g')))::int as description_length,
       (date '2024-01-01' + (conv_id % 400)::int)::varchar as created_day, year(date '2024-01-01' + (conv_id % 400)::int)::int as created_year,
       month(date '2024-01-01' + (conv_id % 400)::int)::int as created_month from conversations""",
)
def derived_ticket_columns(t: Tables):
    created = F.date_add(F.lit(date(2024, 1, 1)), (F.col("conv_id") % 400).cast("int")).cast("timestamp")
    rows = t.conversations.withColumnsRenamed({"text": "description"}).withColumn("created_at", created)
    columns = derived.ticket_columns()
    columns["created_day"] = columns.pop("created_date")
    return rows.select("conv_id", "turn", *[v.alias(k) for k, v in columns.items()])


@query(
    "derived_event_columns",
    """select event_id, cast(ts as date)::varchar as event_date, event_type = 'signup' as is_login,
       event_type = 'view' as is_content_view, event_type = 'click' as is_feature_used,
       event_type = 'purchase' as is_session_end, event_type <> 'error' as is_known_event_type from events""",
)
def derived_event_columns(t: Tables):
    rows = t.sql(
        """select event_id, cast(ts as string) as event_timestamp, case event_type when 'signup' then 'login'
           when 'view' then 'content_view' when 'click' then 'feature_used' when 'purchase' then 'session_end'
           else event_type end as event_type from {events}"""
    )
    return rows.select("event_id", *[v.alias(k) for k, v in derived.event_columns().items()])


@query(
    "derived_product_columns",
    """select p_partkey, split_part(p_name, ' ', 1) as product_family, case p_type when 'PROMO' then 'consumer'
       when 'LARGE' then 'business' else 'other' end as business_line, p_type in ('PROMO', 'LARGE') as is_known_category
       from part""",
)
def derived_product_columns(t: Tables):
    rows = t.sql(
        """select p_partkey, p_name as product_name, case p_type when 'PROMO' then 'Streaming'
           when 'LARGE' then 'Cloud Tools' else p_type end as category from {part}"""
    )
    return rows.select("p_partkey", *[v.alias(k) for k, v in derived.product_columns().items()])


_TAKEN = """select l_suppkey as license_id, l_shipdate as taken, case when l_linenumber = 7 then null else l_shipdate + DAYS(l_quantity - 3) end as freed
  from {lineitem}"""


@query(
    "peak_seats",
    f"""with a as (select * from ({_TAKEN}) where freed is null or freed > taken),
    e as (select license_id, taken as moment, 1 as change from a union all select license_id, freed, -1 from a where freed is not null),
    c as (select license_id, moment, sum(change) as change from e group by 1, 2),
    r as (select license_id, moment, sum(change) over (partition by license_id order by moment) as seats from c)
    select license_id, any_value(top)::bigint as peak, min(moment) filter (seats = top) as peak_at
    from (select *, max(seats) over (partition by license_id) as top from r) group by license_id""",
)
def peak_seats(t: Tables):
    """The most seats of a licence in use at once, and since when."""
    return b.peak_seats(t.sql(_TAKEN), "license_id", "taken", "freed")
