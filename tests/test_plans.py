"""Plan-shape checks behind the scale claims in the README (AQE and
auto-broadcast off, so the static plan is what is inspected)."""

import pytest

from __spark_entry__ import queries
from eventflow.plans.registry import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture()
def static_plans(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def plan(spark, name):
    return queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_joins(static_plans):
    for name in QUERIES:
        p = plan(static_plans, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_top_n_limits_before_the_exchange(static_plans):
    p = plan(static_plans, "e2_hot_items")
    # partial WindowGroupLimit sits below the exchange that feeds the final rank
    assert p.count("WindowGroupLimit") >= 2


def test_json_parsed_once_per_record(static_plans):
    for name in ["s6_decode_event", "e8_mean_id", "g11_reduce_plus"]:
        p = plan(static_plans, name)
        assert "Generate inline" in p and p.count("from_json") == 1, name


def test_filters_and_columns_reach_the_scan(static_plans):
    p = plan(static_plans, "r3_filter")
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value,25.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p
    p = plan(static_plans, "r2_projection")
    assert "ReadSchema: struct<user_id:bigint>" in p


def test_block_scans_have_no_single_partition_on_rows(static_plans):
    # keyed scans: every exchange is hash partitioned (no global ordering)
    for name in ["a3_running_count", "p1_delta_alert", "j2_threshold_alert", "j3_interval_forward"]:
        assert "SinglePartition" not in plan(static_plans, name), name


def test_several_outputs_share_one_scan(static_plans):
    # rows once by (key, block), summaries by (key, block) and by key, the carry back
    for name in ["a2_rolling_sum", "g13_running_detail", "p4_count_timeout"]:
        assert plan(static_plans, name).count("Exchange hashpartitioning") <= 4, name
