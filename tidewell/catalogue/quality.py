"""Validation rules, splits, unions of rejects and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.catalogue.base import Tables, query
from tidewell.operators import quality as q

_HOLED = """(select o_orderkey, o_custkey, o_totalprice, o_orderstatus,
  case when o_orderpriority <> '4-NOT SPECIFIED' then o_orderpriority end as o_orderpriority from orders)"""


def _holed(t: Tables):
    """Orders whose unspecified priority is null."""
    return t.sql(
        """select o_orderkey, o_custkey, o_totalprice, o_orderstatus,
           nullif(o_orderpriority, '4-NOT SPECIFIED') as o_orderpriority from {orders}"""
    )


_REQUIRED = ["o_orderkey", "o_custkey", "o_orderpriority"]


@query("required_not_null_valid", f"select * from {_HOLED} where o_orderpriority is not null")
def required_valid(t: Tables):
    return q.split(_holed(t), q.all_required(_REQUIRED))[0]


@query(
    "required_not_null_quarantine",
    f"select *, 'o_orderpriority is null' as validation_error from {_HOLED} where o_orderpriority is null",
)
def required_quarantine(t: Tables):
    return q.split(_holed(t), q.all_required(_REQUIRED))[1]


@query(
    "required_date",
    """select o_orderkey, cast(o_orderdate as date)::varchar as issued from orders where o_orderstatus <> 'P'""",
)
def required_date(t: Tables):
    raw = t.sql(
        """select o_orderkey, case when o_orderstatus = 'P' then 'pending'
           else cast(cast(o_orderdate as date) as string) end as issued from {orders}"""
    )
    typed = raw.withColumn("issued", F.try_to_date("issued"))
    return q.valid_rows(typed, [q.required("issued")])


_DOMAIN = [q.one_of("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"], "invalid priority")]


@query(
    "domain_allowlist_valid",
    f"select * from {_HOLED} where o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')",
)
def domain_valid(t: Tables):
    return q.split(_holed(t), _DOMAIN)[0]


@query(
    "domain_allowlist_quarantine",
    f"""select *, 'invalid priority' as validation_error from {_HOLED}
        where coalesce(o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM'), true)""",
)
def domain_quarantine(t: Tables):
    """Nulls are quarantined, not lost."""
    return q.split(_holed(t), _DOMAIN)[1]


@query("range_check_valid", "select * from part where p_size between 5 and 40")
def range_valid(t: Tables):
    return q.split(t.part, [q.within("p_size", 5, 40)])[0]


@query(
    "range_check_quarantine",
    "select *, 'p_size outside 5-40' as validation_error from part where p_size not between 5 and 40",
)
def range_quarantine(t: Tables):
    return q.split(t.part, [q.within("p_size", 5, 40)])[1]


_DATED = """select l_orderkey, l_linenumber, l_shipdate as starts,
  case when l_returnflag <> 'N' then l_shipdate + DAYS(l_quantity - 20) end as ends from {lineitem}"""


@query(
    "date_order_check",
    f"""select *, coalesce(ends is null or starts <= ends, false) as open_ok, coalesce(starts < ends, false) as strict_ok
        from ({_DATED})""",
)
def date_order(t: Tables):
    open_end = q.ordered("starts", "ends", open_end=True)
    strict = q.ordered("starts", "ends", strict=True)
    return t.sql(_DATED).withColumns({"open_ok": open_end.ok(), "strict_ok": strict.ok()})


_STATUS_RULE = q.Rule(
    "price_matches_status",
    "(o_orderstatus = 'P' and o_totalprice < 100000) or (o_orderstatus <> 'P' and o_totalprice > 100000)",
    "price does not fit status",
)


@query(
    "conditional_rule",
    """select o_orderkey, (o_orderstatus = 'P' and o_totalprice < 100000)
       or (o_orderstatus <> 'P' and o_totalprice > 100000) as is_valid_price_matches_status from orders""",
)
def conditional(t: Tables):
    flagged = q.with_flags(t.orders, [_STATUS_RULE], "record")
    return flagged.select("o_orderkey", "is_valid_price_matches_status")


@query("sign_check", "select c_custkey, c_acctbal from customer where c_acctbal >= 0")
def sign(t: Tables):
    return q.valid_rows(t.customer, [q.not_negative("c_acctbal")]).select("c_custkey", "c_acctbal")


_LINE_RULES = [
    q.within("l_quantity", 2, 48),
    q.one_of("l_returnflag", ["A", "R"], "invalid flag"),
    q.Rule("discount_limit", "l_discount <= 0.08", "discount too high"),
    q.Rule("taxed", "l_tax > 0", "not taxed"),
]
_LINE_ERRORS = """concat_ws('; ',
  case when l_quantity not between 2 and 48 then 'l_quantity outside 2-48' end,
  case when l_returnflag not in ('A', 'R') then 'invalid flag' end,
  case when l_discount > 0.08 then 'discount too high' end,
  case when l_tax <= 0 then 'not taxed' end)"""


@query(
    "validation_error_text",
    f"select l_orderkey, l_linenumber, l_partkey, {_LINE_ERRORS} as validation_error from lineitem",
)
def error_text(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", q.error_text(_LINE_RULES).alias("validation_error")
    )


@query(
    "record_flags",
    f"""select l_orderkey, l_linenumber, l_partkey, l_quantity between 2 and 48 as is_valid_l_quantity_range,
        l_returnflag in ('A', 'R') as is_valid_l_returnflag_domain, l_discount <= 0.08 as is_valid_discount_limit,
        l_tax > 0 as is_valid_taxed, {_LINE_ERRORS} = '' as is_valid_record from lineitem""",
)
def record_flags(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_discount", "l_tax"
    )
    return q.with_flags(rows, _LINE_RULES).drop("l_quantity", "l_returnflag", "l_discount", "l_tax")


@query(
    "quarantine_union",
    """select c_custkey, null as s_suppkey, 'invalid c_acctbal' as validation_error from customer where c_acctbal < 0
       union all select null, s_suppkey, 'invalid s_acctbal' from supplier where s_acctbal < 0
       union all select null, null, 'p_size outside 5-40' from part where p_size not between 5 and 40""",
)
def quarantine_union(t: Tables):
    """Rejects of three tables; columns a table lacks are null."""
    customers = q.split(t.customer, [q.not_negative("c_acctbal")])[1]
    suppliers = q.split(t.supplier, [q.not_negative("s_acctbal")])[1]
    parts = q.split(t.part, [q.within("p_size", 5, 40)])[1]
    return q.union_all([customers, suppliers, parts]).select("c_custkey", "s_suppkey", "validation_error")


@query(
    "quarantine_envelope",
    """select 'supplier' as entity, case when s_acctbal < 0 then 'invalid s_acctbal' else 'invalid nation' end as rule,
       concat_ws('; ', case when s_acctbal < 0 then 'invalid s_acctbal' end,
                 case when s_nationkey > 12 then 'invalid nation' end) as reason,
       '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}' as payload, 'b7' as batch_id
       from supplier where s_acctbal < 0 or s_nationkey > 12""",
)
def quarantine_envelope(t: Tables):
    rules = [q.not_negative("s_acctbal"), q.Rule("nation", "s_nationkey <= 12", "invalid nation")]
    failed = t.supplier.withColumn("failed", q.broken(rules)).filter(F.size("failed") > 0)
    return q.envelope(failed.select("s_suppkey", "s_name", "failed"), "supplier", "failed", "b7")


@query(
    "quality_report_lineitem",
    f"""select 'lineitem' as entity, measure, count(*) as row_count from (select unnest(case when e = ''
        then ['accepted rows'] else list_concat(['rejected rows'], string_split(e, '; ')) end) as measure
        from (select {_LINE_ERRORS} as e from lineitem)) group by measure""",
)
def report(t: Tables):
    audited = t.lineitem.withColumn("failed", q.broken(_LINE_RULES))
    return q.quality_report(audited, "failed", "lineitem")


@query(
    "except_distinct",
    """select o_custkey as c_custkey from orders where o_orderstatus = 'F'
       except select c_custkey from customer where c_acctbal > 0""",
)
def except_distinct(t: Tables):
    finished = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return finished.subtract(t.customer.filter("c_acctbal > 0").select("c_custkey"))


@query(
    "except_all",
    """select o_custkey as c_custkey from orders where o_orderstatus = 'F'
       except all select o_custkey from orders where o_orderpriority = '1-URGENT'""",
)
def except_all(t: Tables):
    finished = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return finished.exceptAll(t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"))
