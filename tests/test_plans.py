"""What the physical plans must and must not hold."""

import re

import pytest
from conftest import physical

from tidewell.catalogue import registered

FOLDER = "/root/testdata/sf0.001"
# These run streams or write tables when they are called; the plans inside are
# the ones of the operators checked here.
WRITING = {"landing_stream", "landing_stream_with_copies", "stream_dedup", "json_stream", "foreach_batch_upsert",
           "publish_subscriptions", "upsert_lake", "landing_to_bronze", "seed_restamp_all", "bronze_append_evolve",
           "changed_files", "surrogate_keys", "paged_copy", "ordered_page", "previous_status", "csv_set_discovery", "year_month_partition_counts", "churn_scores", "customer_segments",
           "churn_scores_facts", "customer_segments_facts", "upsert_lake_rebucketed", "upsert_lake_repeated_keys",
           "upsert_lake_new_column", *[name for name in registered() if name.startswith("accounted_")]}


@pytest.mark.parametrize("name", sorted(set(registered()) - WRITING))
def test_no_python_and_no_cross_join(spark, name):
    plan = physical(registered()[name].run(spark, FOLDER))
    assert not re.search(r"Python|Pandas|ArrowEval|MapIn", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", [f"silver_{e}" for e in ("users", "payments", "usage_events")])
def test_curated_batches_limit_groups_before_the_shuffle(spark, name):
    plan = physical(registered()[name].run(spark, FOLDER))
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan)) == 2
    assert plan.count("from_json") <= 2


def test_scans_read_needed_columns_only(spark):
    plan = physical(registered()["session_rollup"].run(spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    plan = physical(registered()["sign_check"].run(spark, FOLDER))
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan


def test_references_carry_no_hint(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("fk_semi", "fk_anti", "multi_fk_flags", "risk_marking", "dim_lookup"):
        plan = physical(registered()[name].run(spark, FOLDER))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
