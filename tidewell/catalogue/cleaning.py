"""Deduplication, casts, text and date expressions, nested data, numbering."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewell.catalogue.base import Tables, query
from tidewell.functions import casting, dates, derived, text
from tidewell.operators import dedup, keys, nested
from tidewell.operators.quality import value_profile
from tidewell.sources.lineage import canonical_lineage, drop_technical, stamp_bronze, stamp_landing

_LINE_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)
_RANKED_LINES = f"""
select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc nulls last, {_LINE_REST}) as rn from lineitem"""


@query("dedup_latest_kept", f"select * exclude (rn) from ({_RANKED_LINES}) where rn = 1")
def dedup_latest_kept(t: Tables):
    return dedup.latest(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("dedup_latest_dropped", f"select * exclude (rn) from ({_RANKED_LINES}) where rn > 1")
def dedup_latest_dropped(t: Tables):
    return dedup.superseded(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "batch_dedup_two_key_order",
    """select * exclude (rn) from (select *, row_number() over (partition by o_custkey
       order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""",
)
def batch_dedup_two_key_order(t: Tables):
    return dedup.latest(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


_LINE_COLUMNS = f"l_orderkey, l_linenumber, l_shipdate, {_LINE_REST}"


@query(
    "dedup_repeated_loads",
    f"""select {_LINE_COLUMNS} from (select *, row_number() over (partition by {_LINE_COLUMNS} order by load desc)
        as rn from (select *, 1 as load from lineitem union all select *, 2 from lineitem)) where rn > 1""",
)
def dedup_repeated_loads(t: Tables):
    """Everything loaded twice: what the second load supersedes."""
    loads = t.lineitem.withColumn("load", F.lit(1)).unionByName(t.lineitem.withColumn("load", F.lit(2)))
    return dedup.superseded(loads, t.lineitem.columns, ["load"]).drop("load")


@query(
    "typed_projection",
    """select cast(o_orderkey as int) as order_id, cast(o_totalprice as decimal(18,2))::double as price,
       cast(cast(o_orderdate as date) as varchar) as ordered_on, o_orderstatus as status from orders""",
)
def typed_projection(t: Tables):
    return casting.typed_select(
        t.orders,
        {
            "order_id <- o_orderkey": "int",
            "price <- o_totalprice": "decimal(18,2)",
            "ordered_on <- o_orderdate": "date",
            "status <- o_orderstatus": "string",
        },
    )


@query(
    "lenient_cast",
    """select o_orderkey, try_cast(o_orderpriority as int) as priority_number,
       try_cast(substr(o_orderpriority, 1, 1) as int) as priority_digit,
       try_cast(case when o_orderstatus = 'F' then 'yes' when o_orderstatus = 'O' then 'false'
                else 'maybe' end as boolean) as is_done,
       try_cast(cast(o_orderdate as varchar) as timestamp) as ordered_at,
       try_cast(case when o_orderstatus = 'P' then '1998-13-45' else '1998-12-31' end as date)::varchar as due
       from orders""".replace("'yes'", "'true'"),
)
def lenient_cast(t: Tables):
    raw = t.sql(
        """select o_orderkey, o_orderpriority as priority_number,
           substr(o_orderpriority, 1, 1) as priority_digit,
           case when o_orderstatus = 'F' then 'yes' when o_orderstatus = 'O' then 'false' else 'maybe' end as is_done,
           cast(o_orderdate as string) as ordered_at,
           case when o_orderstatus = 'P' then '1998-13-45' else '1998-12-31' end as due
           from {orders}"""
    )
    return casting.typed_columns(
        raw,
        {
            "priority_number": "int",
            "priority_digit": "int",
            "is_done": "boolean",
            "ordered_at": "timestamp",
            "due": "date",
        },
    )


@query(
    "text_normalise",
    """select c_custkey, c_mktsegment as segment, lower(c_mktsegment) as segment_low,
       upper(c_name) as name_up, lower(regexp_replace(trim(p), '\\s+', '_', 'g')) as segment_snake,
       trim(regexp_replace(p, '\\s+', ' ', 'g')) as segment_squeezed
       from (select *, '  ' || c_mktsegment || '  ' || c_name || ' ' as p from customer)""",
)
def text_normalise(t: Tables):
    padded = t.customer.withColumns(
        {
            "padded": F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")),
            "both": F.concat(F.lit("  "), "c_mktsegment", F.lit("  "), "c_name", F.lit(" ")),
        }
    )
    return padded.select(
        "c_custkey",
        text.trimmed("padded").alias("segment"),
        text.lowered("padded").alias("segment_low"),
        text.uppered("c_name").alias("name_up"),
        text.snaked("both").alias("segment_snake"),
        text.squeezed("both").alias("segment_squeezed"),
    )


@query(
    "initcap_domain_fallback",
    """select c_custkey, s in ('Building', 'Machinery') as is_known,
       case when s in ('Building', 'Machinery') then s else 'Other' end as segment
       from (select c_custkey, upper(c_mktsegment[1:1]) || lower(c_mktsegment[2:]) as s from customer)""",
)
def initcap_domain_fallback(t: Tables):
    segment, known = text.titled("c_mktsegment"), ["Building", "Machinery"]
    return t.customer.select(
        "c_custkey",
        segment.isin(known).alias("is_known"),
        text.domain_or_other(segment, known).alias("segment"),
    )


@query(
    "blank_to_null",
    """select c_custkey, c_name, case when c_acctbal >= 0 then c_mktsegment end as c_mktsegment
       from customer""",
)
def blank_to_null(t: Tables):
    blanked = F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.col("c_mktsegment"))
    return casting.blanks_to_null(
        t.customer.select("c_custkey", "c_name", blanked.alias("c_mktsegment"))
    )


@query(
    "bytes_to_text",
    "select doc_id, text, case when n_chars > 500 then n_chars::double end as size from documents",
)
def bytes_to_text(t: Tables):
    """Texts with broken bytes put around them come back clean; NaN is null."""
    broken = F.concat(F.unhex(F.lit("FF")), F.col("text").cast("binary"), F.unhex(F.lit("FE")))
    size = F.when(F.col("n_chars") > 500, F.col("n_chars").cast("double")).otherwise(F.lit(float("nan")))
    raw = t.documents.select("doc_id", broken.alias("text"), size.alias("size"))
    return raw.select(
        "doc_id", casting.utf8_text("text").alias("text"), casting.number_or_null("size").alias("size")
    )


@query(
    "clamp_dates",
    """select l_orderkey, l_linenumber, cast(ship as varchar) as ship,
       case when done is not null then cast(greatest(done, ship) as varchar) end as done_on,
       cast(coalesce(done, ship + 365) as varchar) as done_or_default,
       greatest(date_diff('day', ship, done), 1)::int as days_taken
       from (select l_orderkey, l_linenumber, cast(l_shipdate as date) as ship,
             case when l_returnflag <> 'N' then cast(l_shipdate as date) + cast(l_quantity - 20 as int) end as done
             from lineitem)""",
)
def clamp_dates(t: Tables):
    shipped = t.lineitem.withColumn("ship", F.to_date("l_shipdate"))
    moved = F.date_add("ship", (F.col("l_quantity") - 20).cast("int"))
    spans = shipped.withColumn("done", F.when(F.col("l_returnflag") != "N", moved))
    return spans.select(
        "l_orderkey",
        "l_linenumber",
        "ship",
        dates.end_not_before("ship", "done").alias("done_on"),
        dates.end_or_default("ship", "done").alias("done_or_default"),
        dates.span_days("ship", "done").alias("days_taken"),
    )


@query(
    "event_time_slice_day",
    "select * from events where ts >= timestamp '2024-01-15' and ts < timestamp '2024-01-16'",
)
def event_time_slice_day(t: Tables):
    return t.events.filter(dates.on_day("ts", date(2024, 1, 15)))


@query(
    "event_time_slice_month",
    "select * from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01'",
)
def event_time_slice_month(t: Tables):
    return t.events.filter(dates.in_month("ts", date(2024, 1, 1)))


@query(
    "event_time_slice_month_short",
    "select * from orders where o_orderdate >= timestamp '1998-02-01' and o_orderdate < timestamp '1998-03-01'",
)
def event_time_slice_month_short(t: Tables):
    """The shortest month, all of its days."""
    return t.orders.filter(dates.in_month("o_orderdate", date(1998, 2, 14)))


@query(
    "status_slice",
    "select o_orderkey as subscription_id from orders where o_orderstatus = 'O'",
)
def status_slice(t: Tables):
    return t.orders.filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("subscription_id"))


@query(
    "json_parse_flatten",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as payload_props_k,
       event_type as payload_kind, value as payload_measure_value, user_id as payload_measure_user
       from events""",
)
def json_parse_flatten(t: Tables):
    """Nested documents are built from the events, parsed and flattened."""
    documents = t.events.select(
        "event_id",
        F.to_json(
            F.struct(
                F.struct(
                    F.from_json("props", "k bigint").alias("props"),
                    F.col("event_type").alias("kind"),
                    F.struct(F.col("value"), F.col("user_id").alias("user")).alias("measure"),
                ).alias("payload")
            )
        ).alias("data"),
    )
    schema = "payload struct<props: struct<k: bigint>, kind: string, measure: struct<value: double, user: bigint>>"
    return nested.flatten_structs(nested.parse_json(documents, "data", schema))


@query(
    "json_infer_schema",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
)
def json_infer_schema(t: Tables):
    schema = nested.infer_json_schema(t.events, "props")
    return nested.parse_json(t.events.select("event_id", "props"), "props", schema)


@query(
    "lineage_stamp",
    """select o_orderkey, timestamp '2024-05-01 12:00:00' as dw_ingested_at, 'orders.csv' as dw_source_file,
       'batch-7' as dw_batch_id from orders""",
)
def lineage_stamp(t: Tables):
    from datetime import datetime

    at = datetime(2024, 5, 1, 12)
    return stamp_landing(t.orders.select("o_orderkey"), "batch-7", at, "orders.csv")


@query(
    "canonical_lineage",
    """select c_custkey, timestamp '2024-05-01 12:00:00' as ingest_time, 'customer' as source_identifier,
       'b1' as batch_id from customer
       union all select s_suppkey, timestamp '2024-05-02 00:00:00', 'suppliers.csv', 'b2' from supplier""",
)
def canonical(t: Tables):
    from datetime import datetime

    bronze = stamp_bronze(t.customer.select("c_custkey"), "b1", "customer", datetime(2024, 5, 1, 12))
    landing = stamp_landing(
        t.supplier.select(F.col("s_suppkey").alias("c_custkey")), "b2", datetime(2024, 5, 2), "suppliers.csv"
    )
    return canonical_lineage(bronze).unionByName(canonical_lineage(landing))


@query("drop_technical", "select o_orderkey, o_totalprice from orders")
def technical(t: Tables):
    stamped = t.orders.select(
        "o_orderkey", "o_totalprice", F.col("o_orderkey").alias("id"), F.lit("b").alias("batch_id")
    )
    return drop_technical(stamped)


@query(
    "rename_clash",
    """select event_id, ts as created_at_event, json_extract_string(props, '$.k') as created_at from events""",
)
def rename_clash(t: Tables):
    outer = t.events.select("event_id", F.col("ts").alias("created_at"), "props")
    payload = F.replace("props", F.lit('"k"'), F.lit('"created_at"'))
    renamed = outer.withColumnRenamed("created_at", "created_at_event").withColumn("props", payload)
    return nested.parse_json(renamed, "props", "created_at string")


@query(
    "distinct_profile",
    "select o_orderpriority as value, count(*) as row_count from orders group by 1",
)
def distinct_profile(t: Tables):
    return value_profile(t.orders, "o_orderpriority")


@query("distinct_rows", "select distinct l_orderkey, l_linenumber from lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber").distinct()


@query(
    "surrogate_keys",
    """select o_orderkey, o_orderdate, 1000 + row_number() over (order by o_orderdate, o_orderkey) as order_number
       from orders""",
)
def surrogate(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return keys.surrogate_keys(rows, ["o_orderdate", "o_orderkey"], "order_number", start_after=1000)


@query(
    "paged_copy",
    """select o_orderkey, cast((row_number() over (order by o_orderdate, o_orderkey) - 1) // 5000 as bigint) as page
       from orders""",
)
def paged_copy(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return keys.paginate(rows, ["o_orderdate", "o_orderkey"], 5000).drop("o_orderdate")


@query(
    "ordered_page",
    "select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey limit 500 offset 500",
)
def ordered_page(t: Tables):
    return keys.one_page(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 500, 500)


@query(
    "previous_status",
    """select o_orderkey, o_custkey, o_orderstatus as status,
       lag(o_orderstatus) over (partition by o_custkey order by o_orderdate, o_orderkey) as previous_status
       from orders""",
)
def previous_status(t: Tables):
    return keys.previous_value(
        t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus", "previous_status"
    ).select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), "previous_status")


@query(
    "keyword_category",
    """select doc_id, case when regexp_matches(lower(text), 'technical|bug|error|account|network') then 'technical'
       when regexp_matches(lower(text), 'billing|payment|refund') then 'billing'
       when regexp_matches(lower(text), 'cancel') then 'cancellation' else 'feature_request' end as category
       from documents""",
)
def keyword_category(t: Tables):
    return t.documents.select("doc_id", text.ticket_category("text").alias("category"))


@query(
    "keyword_category_of_event",
    """select event_id, case when event_type = 'error' then 'technical' when event_type = 'purchase' then 'billing'
       when event_type = 'signup' then 'cancellation' else 'feature_request' end as category from events""",
)
def keyword_category_of_event(t: Tables):
    words = F.create_map(
        *[F.lit(w) for w in ("error", "An ERROR, refund it", "purchase", "Payment?", "signup", "I Cancelled")]
    )
    subject = F.coalesce(words[F.col("event_type")], F.col("event_type"))
    return t.events.withColumn("subject", subject).select(
        "event_id", text.ticket_category("subject").alias("category")
    )


@query(
    "meaningless_text",
    """select conv_id, turn, lower(trim(coalesce(case when role = 'system' then ' N/A ' else text end, '')))
       in ('', 'n/a', 'na', 'none', 'null', 'test', 'no description') as is_meaningless from conversations""",
)
def meaningless_text(t: Tables):
    said = F.when(F.col("role") == "system", F.lit(" N/A ")).otherwise(F.col("text"))
    return t.conversations.withColumn("said", said).select(
        "conv_id", "turn", text.is_meaningless("said").alias("is_meaningless")
    )


@query(
    "derived_user_columns",
    """select c_custkey, year(c)::int as created_year, month(c)::int as created_month,
       date_diff('day', cast(c as date), date '2024-06-30')::int as user_tenure_days,
       cast(date_diff('month', cast(c as date), date '2024-06-30')
         - case when day(c) > 30 then 1 else 0 end as int) as user_tenure_months,
       case when age < 25 then '18-24' when age < 35 then '25-34' when age < 45 then '35-44'
            when age < 55 then '45-54' when age < 65 then '55-64' else '65+' end as age_group,
       regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s.]+$') as is_valid_email
       from (select *, timestamp '2023-01-01' + to_days(cast(c_nationkey as int)) as c,
                    18 + c_custkey % 60 as age, replace(c_name, '#', case when c_acctbal < 0 then ' ' else '@' end) || '.com' as email
             from customer)""",
)
def derived_user_columns(t: Tables):
    users = t.sql(
        """select c_custkey, timestamp '2023-01-01 00:00:00' + DAYS(c_nationkey) as created_at,
           18 + c_custkey % 60 as age,
           replace(c_name, '#', case when c_acctbal < 0 then ' ' else '@' end) || '.com' as email
           from {customer}"""
    )
    columns = derived.user_columns(F.lit(date(2024, 6, 30)))
    return users.withColumns(columns).select("c_custkey", *columns)


@query(
    "derived_payment_columns",
    """select l_orderkey, l_linenumber, l_shipdate::date::varchar as payment_date_, year(l_shipdate)::int as payment_year,
       month(l_shipdate)::int as payment_month, l_returnflag = 'A' as is_successful, l_returnflag = 'N' as is_failed,
       l_returnflag = 'R' as is_refunded from lineitem""",
)
def derived_payment_columns(t: Tables):
    status = F.when(F.col("l_returnflag") == "A", "success").when(F.col("l_returnflag") == "N", "failed")
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("payment_date"),
        status.otherwise("refunded").alias("payment_status"),
    )
    columns = derived.payment_columns()
    wide = rows.withColumns({("payment_date_" if k == "payment_date" else k): v for k, v in columns.items()})
    return wide.drop("payment_date", "payment_status")
