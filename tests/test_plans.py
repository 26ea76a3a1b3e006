"""Physical plans: what is pushed, pruned, broadcast, and kept out of Python."""

from __future__ import annotations

from datetime import timedelta

import pytest

from sensorspan.operators.filters import time_filter
from sensorspan.registry import QUERIES
from sensorspan.registry.core import AS_OF, FROM, TO
from sensorspan.sinks.layout import write_clustered
from sensorspan.registry import core

SF = "/root/testdata/sf0.001"

# Written in batches by Arrow, for the brackets around an array.
ARROW = {"scan_json_array", "sink_json_array"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    lazy = [n for n in QUERIES if not n.startswith(("stream_", "sink_", "lake_"))]
    skip = {"ensure_tables", "scan_snapshot", "publish_snapshot", "sync_tables"}
    skip |= {"expire_snapshots", "retention_partitions", "retention_hourly", "load_out_of_order"}
    return {n: plan(QUERIES[n](spark, SF)) for n in lazy if n not in skip}


def test_no_query_runs_python_or_a_cross_join(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in text, name


def test_no_query_gathers_groups(plans):
    for name, text in plans.items():
        assert "collect_list" not in text, name
        assert "collect_set" not in text, name
        assert " Window " not in text, name


@pytest.mark.parametrize(
    "name",
    [
        "filter_last_24h", "filter_time_range", "device_agg_24h", "daily_activity_7d",
        "count_between", "recent_24h", "stats_panel", "radiation_over_time", "yearly_series",
        "map_latest_positions", "hourly_freshness", "device_uptime", "fact_series_range",
    ],
)
def test_time_bounds_reach_the_scan(plans, name):
    pushed = [line for line in plans[name].split("PushedFilters")[1:]]
    assert any("OrEqual(ts" in line.split("]")[0] for line in pushed), plans[name]


def test_only_needed_columns_are_read(plans):
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plans["hourly_freshness"]
    assert "props" not in plans["basic_stats"].split("ReadSchema")[1]
    assert "nation" not in plans["device_agg_24h"]


def test_top_rows_are_not_sorted_globally(plans):
    for name in ("country_agg", "top_radiation", "device_agg_24h", "all_devices_24h"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_distinct_counts_combine_before_the_shuffle(plans):
    for name in ("country_agg", "daily_activity_7d", "hourly_active_devices"):
        assert "partial_count(distinct" in plans[name] or "partial_count(device" in plans[name], name


def test_clustered_table_skips_days(spark, tmp_path):
    path = str(tmp_path / "clustered")
    write_clustered(core.measurements(spark, SF), path)
    text = plan(time_filter(spark.read.parquet(path), AS_OF - timedelta(days=2), AS_OF))
    assert "PartitionFilters: [isnotnull(day" in text
    assert spark.read.parquet(path).filter(f"day = '{FROM.date()}'").count() > 0
    assert TO > FROM
