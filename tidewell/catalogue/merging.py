"""Upserts.

The target holds the orders that are finished or open, keyed by order and
stamped with the order date; the batch is what the line items say about each
order, stamped with the ship date.  It meets known and unknown keys, older,
equal and newer stamps.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.catalogue.base import Tables, query
from tidewell.operators.upsert import merge_frames, rebucket, reduce_batch, upsert_path
from tidewell.session import scratch_path
from tidewell.sources.lake import read_lake

TARGET = """select o_orderkey as k, o_totalprice as amount, 'order' as origin,
  case when o_custkey % 20 = 0 then null else o_orderdate end as stamp from {orders} where o_orderstatus <> 'P'"""
LINES = """select l_orderkey as k, l_extendedprice as amount, 'line' as origin,
  case when l_tax = 0.0 then null else l_shipdate end as stamp from {lineitem}"""
_BATCH = f"""select k, amount, origin, stamp from (select *, row_number() over (partition by k
  order by stamp desc nulls last, amount, origin) as rn from ({LINES})) where rn = 1"""


def _merged_sql(condition: str) -> str:
    pick = f"t.k is null or (s.k is not null and {condition})"
    columns = ", ".join(f"case when {pick} then s.{c} else t.{c} end as {c}" for c in ("k", "amount", "origin", "stamp"))
    return f"select {columns} from ({TARGET}) t full join ({_BATCH}) s on t.k = s.k"


def _batch(t: Tables):
    return reduce_batch(t.sql(LINES), ["k"], ["stamp"])


@query("upsert_newer", _merged_sql("coalesce(s.stamp > t.stamp, false)"))
def upsert_newer(t: Tables):
    return merge_frames(t.sql(TARGET), _batch(t), ["k"], newer_than="stamp")


@query("upsert_always", _merged_sql("true"))
def upsert_always(t: Tables):
    return merge_frames(t.sql(TARGET), _batch(t), ["k"])


_PAIR_TARGET = """select l_orderkey as k, l_linenumber as n, l_returnflag as flag, l_shipdate as stamp
  from {lineitem} where l_linestatus = 'F'"""
_PAIR_BATCH = """select l_orderkey as k, l_linenumber as n, l_linestatus as flag, l_shipdate as stamp
  from {lineitem}"""


def _latest_pair(text: str) -> str:
    return f"""(select k, n, flag, stamp from (select *, row_number() over (partition by k, n
      order by stamp desc, flag) as rn from ({text})) where rn = 1)"""


@query(
    "upsert_composite",
    f"""select coalesce(t.k, s.k) as k, coalesce(t.n, s.n) as n,
        case when t.k is null or s.stamp > t.stamp then s.flag else t.flag end as flag,
        case when t.k is null or s.stamp > t.stamp then s.stamp else t.stamp end as stamp
        from {_latest_pair(_PAIR_TARGET)} t full join {_latest_pair(_PAIR_BATCH)} s on t.k = s.k and t.n = s.n""",
)
def upsert_composite(t: Tables):
    target = reduce_batch(t.sql(_PAIR_TARGET), ["k", "n"], ["stamp"])
    batch = reduce_batch(t.sql(_PAIR_BATCH), ["k", "n"], ["stamp"])
    return merge_frames(target, batch, ["k", "n"], newer_than="stamp")


@query("upsert_lake", _merged_sql("coalesce(s.stamp > t.stamp, false)"))
def upsert_lake(t: Tables):
    """The same upsert into a stored table, the batch delivered twice."""
    path = scratch_path(t.spark, "upsert-lake")
    upsert_path(t.spark, path, t.sql(TARGET), ["k"], "stamp", buckets=4)
    for _ in range(2):
        upsert_path(t.spark, path, _batch(t), ["k"], "stamp", buckets=4)
    return read_lake(t.spark, path).select("k", "amount", "origin", "stamp")


@query(
    "upsert_null_keys",
    f"""select t.* from (select nullif(k, 1) as k, amount, origin, stamp from ({TARGET})) t
        where t.k is null or t.k not in (select k from ({_BATCH}))
        union all select * from ({_BATCH})""",
)
def upsert_null_keys(t: Tables):
    """A target row without a key matches nothing and stays."""
    target = t.sql(TARGET).withColumn("k", F.nullif("k", F.lit(1)))
    return merge_frames(target, _batch(t), ["k"])


@query("upsert_lake_rebucketed", _merged_sql("coalesce(s.stamp > t.stamp, false)"))
def upsert_lake_rebucketed(t: Tables):
    """Another bucket count is refused; after re-bucketing the batch finds its keys."""
    path = scratch_path(t.spark, "upsert-rebucketed")
    upsert_path(t.spark, path, t.sql(TARGET), ["k"], "stamp", buckets=4)
    try:
        upsert_path(t.spark, path, _batch(t), ["k"], "stamp", buckets=7)
        raise AssertionError("another number of buckets was taken")
    except ValueError:
        rebucket(t.spark, path, 7)
    upsert_path(t.spark, path, _batch(t), ["k"], "stamp", buckets=7)
    upsert_path(t.spark, path, _batch(t), ["k"], "stamp")
    return read_lake(t.spark, path).select("k", "amount", "origin", "stamp")


@query("upsert_lake_repeated_keys", _merged_sql("coalesce(s.stamp > t.stamp, false)"))
def upsert_lake_repeated_keys(t: Tables):
    """The batch holds every line of an order; the newest counts."""
    path = scratch_path(t.spark, "upsert-repeated")
    upsert_path(t.spark, path, t.sql(TARGET), ["k"], "stamp", buckets=4)
    upsert_path(t.spark, path, t.sql(LINES), ["k"], "stamp")
    return read_lake(t.spark, path).select("k", "amount", "origin", "stamp")


@query(
    "upsert_lake_new_column",
    f"select m.*, case when origin = 'line' then k % 7 end as extra from ({_merged_sql('coalesce(s.stamp > t.stamp, false)')}) m",
)
def upsert_lake_new_column(t: Tables):
    """The batch brings a column; a later batch without it leaves it as it is."""
    path = scratch_path(t.spark, "upsert-column")
    upsert_path(t.spark, path, t.sql(TARGET), ["k"], "stamp", buckets=4)
    upsert_path(t.spark, path, _batch(t).withColumn("extra", F.col("k") % 7), ["k"], "stamp")
    upsert_path(t.spark, path, _batch(t).filter("k % 2 = 0"), ["k"], "stamp")
    return read_lake(t.spark, path).select("k", "amount", "origin", "stamp", "extra")
