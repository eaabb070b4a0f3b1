"""Referential checks and dimension lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.catalogue.base import Tables, query
from tidewell.operators import references as r

_SOLVENT = "(select c_custkey from customer where c_acctbal > 0)"


def _solvent(t: Tables):
    return t.customer.filter("c_acctbal > 0")


_CUSTOMER = {"o_custkey": "c_custkey"}


@query("fk_semi", f"select * from orders where o_custkey in {_SOLVENT}")
def fk_semi(t: Tables):
    return r.having_reference(t.orders, _solvent(t), _CUSTOMER)


@query("fk_anti", f"select * from orders where o_custkey not in {_SOLVENT}")
def fk_anti(t: Tables):
    return r.lacking_reference(t.orders, _solvent(t), _CUSTOMER)


@query("fk_inner", f"select o.* from orders o join (select distinct c_custkey from {_SOLVENT}) on o_custkey = c_custkey")
def fk_inner(t: Tables):
    """Inner join with unique keys: the same rows as the semi join."""
    keys = r.unique_keys(_solvent(t).select(F.col("c_custkey").alias("o_custkey")))
    return t.orders.join(keys, "o_custkey", "inner")


@query(
    "fk_left_null",
    f"""select o.*, 'customer not found' as quarantine_reason from orders o
        left join {_SOLVENT} on o_custkey = c_custkey where c_custkey is null""",
)
def fk_left_null(t: Tables):
    return r.reference_split(t.orders, _solvent(t), _CUSTOMER, "customer not found")[1]


_PARTS = "(select p_partkey from part where p_size > 10)"
_SUPPLIERS = "(select s_suppkey from supplier where s_acctbal > 0)"


@query(
    "multi_fk_flags",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey not in {_PARTS} as is_missing_part,
        coalesce(l_suppkey not in {_SUPPLIERS}, false) as is_missing_supplier
        from (select l_orderkey, l_linenumber, l_partkey,
                     case when l_returnflag <> 'N' then l_suppkey end as l_suppkey from lineitem)""",
)
def multi_fk_flags(t: Tables):
    """A null supplier is allowed, an unknown one is not."""
    rows = t.sql(
        """select l_orderkey, l_linenumber, l_partkey,
           case when l_returnflag <> 'N' then l_suppkey end as l_suppkey from {lineitem}"""
    )
    part = r.Reference("part", {"l_partkey": "p_partkey"}, "")
    supplier = r.Reference("supplier", {"l_suppkey": "s_suppkey"}, "", optional=True)
    marked = r.mark_reference(rows, t.part.filter("p_size > 10"), part, "is_missing_part")
    return r.mark_reference(marked, t.supplier.filter("s_acctbal > 0"), supplier, "is_missing_supplier")


@query(
    "fk_repeated_reference_keys",
    "select c_custkey, not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P') as is_missing from customer",
)
def fk_repeated_reference_keys(t: Tables):
    """The reference holds its keys many times; rows must not multiply."""
    spec = r.Reference("orders", {"c_custkey": "o_custkey"}, "")
    pending = t.orders.filter("o_orderstatus = 'P'")
    return r.mark_reference(t.customer.select("c_custkey"), pending, spec, "is_missing")


_ROLES = """(select l_orderkey, l_linenumber, l_partkey as old_plan_id,
  case when l_tax > 0.01 then l_suppkey * 11 end as new_plan_id from lineitem)"""


def _changes(t: Tables):
    return t.sql(
        """select l_orderkey, l_linenumber, l_partkey as old_plan_id,
           case when l_tax > 0.01 then l_suppkey * 11 end as new_plan_id from {lineitem}"""
    )


@query(
    "role_playing_fk",
    f"select * from {_ROLES} where old_plan_id in {_PARTS} and new_plan_id in {_PARTS}",
)
def role_playing_fk(t: Tables):
    return r.with_roles(_changes(t), t.part.filter("p_size > 10"), "p_partkey", ["old_plan_id", "new_plan_id"])


@query(
    "role_playing_fk_complement",
    f"select * from {_ROLES} where not coalesce(old_plan_id in {_PARTS} and new_plan_id in {_PARTS}, false)",
)
def role_playing_fk_complement(t: Tables):
    return r.without_roles(_changes(t), t.part.filter("p_size > 10"), "p_partkey", ["old_plan_id", "new_plan_id"])


@query(
    "dim_lookup",
    """select l_orderkey, l_linenumber, l_partkey, p_type, p_retailprice from lineitem join part on l_partkey = p_partkey""",
)
def dim_lookup(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return r.looked_up(rows, t.part, {"l_partkey": "p_partkey"}, ["p_type", "p_retailprice"])


@query(
    "enterprise_semi",
    "select * from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY')",
)
def enterprise_semi(t: Tables):
    segment = t.customer.filter("c_mktsegment = 'MACHINERY'")
    return r.having_reference(t.orders, segment, _CUSTOMER)
