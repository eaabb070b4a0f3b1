"""The given tables seen as raw rows of the ten entities.

Each text runs on Spark and on the checking engine alike.  The given tables
hold neither nulls nor orphans nor malformed values, so the texts make some
from the values at hand; a second SELECT sends part of the rows again, as a
later load would.
"""

PRODUCTS = """
select p_partkey as id, p_partkey as product_id, '  ' || p_name || ' ' as product_name,
       case when p_size > 45 then null else p_type end as category,
       timestamp '2022-01-01 00:00:00' + DAYS(p_size) as created_at,
       timestamp '2024-01-01 00:00:00' + DAYS(p_size % 7) as ingest_time,
       'seed' as source_identifier, 'b1' as batch_id
from {part}
union all
select p_partkey, p_partkey, p_name || ' II', p_type,
       timestamp '2022-01-01 00:00:00' + DAYS(p_size + p_partkey % 2),
       timestamp '2024-02-01 00:00:00' + DAYS(p_size % 7),
       'seed', 'b2'
from {part} where p_retailprice > 950
"""

_USER = """
select c_custkey as id,
       case when c_custkey % 31 = 0 then 'unknown' else cast(c_custkey as string) end as user_id,
       ' ' || c_name as first_name, c_mktsegment || '  ' as last_name,
       case when c_acctbal < 0 then null else ' ' || upper(c_name) || '@Example.COM ' end as email,
       case c_nationkey % 5 when 0 then ' united states ' when 1 then 'FRANCE'
            when 2 then 'south korea' when 3 then n_name else null end as country,
       case when c_custkey % 37 = 0 then 'old' else cast(15 + c_custkey % 90 as string) end as age,
       case c_custkey % 13 when 0 then 'unknown' when 1 then null when 2 then ' FEMALE '
            when 3 then 'Other' else 'male' end as gender,
       case c_nationkey % 11 when 0 then 'billboard' when 1 then ' Paid' when 2 then 'REFERRAL'
            when 3 then null else 'organic' end as acquisition_channel,
       case c_custkey % 17 when 0 then 'maybe' when 1 then 'yes' else 'false' end as is_enterprise,
       case when c_custkey % 29 = 0 then 'not a date'
            else cast(timestamp '2023-01-01 00:00:00' + DAYS(c_nationkey + {later}) as string) end as created_at,
       cast(timestamp '2024-01-01 06:30:00' + DAYS({load}) as string) as ingest_time,
       'csv' as source_identifier, 'b' || cast({load} as string) as batch_id
from {{customer}} join {{nation}} on c_nationkey = n_nationkey
"""
USERS = (
    _USER.format(later="0", load="0")
    + " union all "
    + _USER.format(later="c_custkey % 2", load="9")
    + " where c_acctbal > 5000"
)

_PLAN = """
select p_partkey as id, cast(p_partkey as string) as plan_id, cast(p_size as string) as product_id,
       case p_partkey % 9 when 0 then 'Free  Trial' when 1 then ' trial' when 2 then 'BASIC'
            when 3 then 'standard ' when 4 then 'Premium' when 5 then 'enterprise' when 6 then 'free'
            when 7 then 'Gold' else null end as tier,
       case p_size % 4 when 0 then 'Monthly' when 1 then ' ANNUAL' when 2 then 'monthly'
            else case when p_partkey % 5 = 0 then 'weekly' else 'annual' end end as billing_cycle,
       case when p_partkey % 23 = 0 then -1.5 else p_retailprice end as price,
       case p_partkey % 6 when 0 then 'usd' when 1 then ' EUR ' when 2 then 'gbp' when 3 then 'VND'
            when 4 then 'USD' else case when p_size > 40 then 'JPY' else 'eur' end end as currency,
       timestamp '2021-01-01 00:00:00' + DAYS(p_size + {later}) as created_at,
       timestamp '2024-01-01 00:00:00' + DAYS({load}) as ingest_time,
       'seed' as source_identifier, 'b' || cast({load} as string) as batch_id
from {{part}}
"""
PLANS = (
    _PLAN.format(later="0", load="0")
    + " union all "
    + _PLAN.format(later="p_partkey % 2", load="7")
    + " where p_retailprice > 950"
)

_SUBSCRIPTION = """
select o_orderkey as id, o_orderkey as subscription_id, o_custkey as user_id,
       case when o_orderpriority = '4-NOT SPECIFIED' then 'none'
            else cast(o_orderkey % 32 + 1 as string) end as plan_id,
       cast(o_orderdate as date) as start_date,
       case when o_orderstatus = 'F' then cast(o_orderdate + DAYS(o_custkey % 400 - 20) as date) end as end_date,
       case o_orderstatus when 'F' then ' Cancelled' when 'O' then 'ACTIVE'
            else case when o_orderpriority = '1-URGENT' then 'paused' else 'trial' end end as status,
       case when o_orderstatus = 'P' then case when o_totalprice > 400000 then 9.75 else 0.0 end
            when o_totalprice < 20000 then null else floor(o_totalprice) / 100 end as current_mrr,
       o_orderdate + DAYS({later}) as created_at, o_orderdate + DAYS({load}) as ingest_time,
       'csv' as source_identifier, 'b' || cast({load} as string) as batch_id
from {{orders}}
"""
SUBSCRIPTIONS = (
    _SUBSCRIPTION.format(later="0", load="1")
    + " union all "
    + _SUBSCRIPTION.format(later="o_custkey % 2", load="2")
    + " where o_orderdate >= timestamp '2000-01-01 00:00:00'"
)

SUBSCRIPTION_CHANGES = """
select l_orderkey * 10 + l_linenumber as change_id, l_orderkey as subscription_id,
       l_partkey as old_plan_id,
       case when l_tax = 0.08 then null else cast(l_suppkey * 7 as string) end as new_plan_id,
       case l_returnflag when 'R' then 'Downgrade' when 'A' then ' upgrade'
            else case when l_linestatus = 'O' then 'INITIAL' else 'renewal' end end as change_type,
       l_shipdate as change_date, l_shipdate + DAYS(l_quantity) as ingest_time
from {lineitem}
"""

PAYMENTS = """
select l_orderkey * 10 + l_linenumber as payment_id, l_orderkey as subscription_id,
       l_extendedprice as amount,
       case l_suppkey % 6 when 0 then 'usd' when 1 then ' EUR' when 2 then 'gbp ' when 3 then 'VND'
            when 4 then 'USD' else case when l_discount > 0.05 then 'JPY' else null end end as currency,
       case l_returnflag when 'R' then 'Refunded' when 'A' then ' success'
            else case when l_tax = 0.0 then 'pending' else 'FAILED' end end as payment_status,
       l_shipdate as payment_date,
       case l_partkey % 8 when 0 then 'google_pay' when 1 then 'PayPal' when 2 then 'apple_pay'
            when 3 then ' credit_card' when 4 then 'bank_transfer' when 5 then 'Invoice'
            when 6 then 'cash' else null end as payment_method,
       l_shipdate + DAYS(l_quantity) as ingest_time
from {lineitem}
"""

_LICENSE = """
select o_orderkey as license_id, o_custkey as subscription_id,
       case when o_totalprice < 9000 then null else floor(o_totalprice / 900) end as max_seats,
       case when o_custkey % 50 = 0 then 'n/a'
            else cast(cast(o_orderdate + DAYS({later}) as date) as string) end as issued_date,
       cast(cast(o_orderdate + DAYS(o_custkey % 730 - 10) as date) as string) as expiry_date,
       o_orderdate + DAYS({load}) as ingest_time
from {{orders}}
"""
LICENSE_KEYS = (
    _LICENSE.format(later="0", load="1")
    + " union all "
    + _LICENSE.format(later="o_custkey % 2", load="2")
    + " where o_orderstatus = 'O'"
)

LICENSE_ALLOCATIONS = """
select l_orderkey * 10 + l_linenumber as allocation_id, l_orderkey as license_id,
       case when l_partkey % 19 = 0 then null else (l_quantity - 1) * 12 end as seat_number,
       case when l_tax = 0.0 then null when l_discount = 0.1 then 'paused'
            when l_linestatus = 'O' then ' Active' else 'DEACTIVATED' end as status,
       l_shipdate as allocation_date, l_shipdate + DAYS(l_quantity) as ingest_time
from {lineitem}
"""

_TICKET = """
select doc_id as ticket_id, n_chars % 2000 as user_id,
       case when source = 'src3' then null else
            case lang when 'en' then ' Technical' when 'fr' then 'billing' when 'de' then 'CANCELLATION'
                 else 'praise' end end as category,
       text as description,
       timestamp '2024-01-01 00:00:00' + SECONDS(n_chars{later}) as created_at,
       timestamp '2024-02-01 00:00:00' + DAYS({load}) as ingest_time
from {{documents}}
"""
SUPPORT_TICKETS = (
    _TICKET.format(later="", load="0")
    + " union all "
    + _TICKET.format(later=" + doc_id % 2", load="3")
    + " where doc_id in (select doc_id from {labels} where quality = 1)"
)

_EVENT = """
select event_id as id,
       case when event_type = 'error' and user_id % 5 = 0 then chr(123) || 'broken'
            else chr(123) || '"event_id":"e' || cast(event_id as string)
                 || '","user_id":' || cast(user_id as string) || ',"subscription_id":'
                 || case when event_type = 'view' then 'null' else cast(user_id * 7 as string) end
                 || ',"event_type":"' || event_type || '","event_timestamp":"' || cast(ts as string)
                 || '","event_properties":' || chr(123) || '"duration_sec":' || cast(user_id * 3 as string)
                 || ',"referrer":"ads"' || chr(125) || ',"platform":"Web","unknown_field":1' || chr(125)
       end as data,
       ts as created_at, case when event_type = 'click' then 'yes' else 'no' end as processed,
       ts + SECONDS({load}) as ingest_time
from {{events}}
"""
USAGE_EVENTS = (
    _EVENT.format(load="3600")
    + " union all "
    + _EVENT.format(load="7200")
    + " where event_type = 'purchase'"
)
