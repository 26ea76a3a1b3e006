"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. The published tables are filled by two loads, timed as
``load_history`` and ``refresh``, the second being one day's feed on top of the
others; ``rebuild`` makes all rollups anew. Then every query runs to its last
row, once to warm up and three times for its median. ``raw_*`` reads the
published facts, ``rollup_*`` the published rollups, ``published_*`` also finds
out what is published. ``empty_job`` is a job over one row: the floor of all.
Files go to ``$BENCH_ROOT``, or to a temporary folder of this machine.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sensorspan.config import session
from sensorspan.operators.latest import latest_by_device, map_latest_positions
from sensorspan.plans import panels
from sensorspan.registry.core import AS_OF, DEVICES, FROM, TO, measurements
from sensorspan.schema import FEED_FIELDS
from sensorspan.sinks.exports import write_ndjson
from sensorspan.sources.feeds import scan_ndjson
from sensorspan.streaming.jobs import positioned
from sensorspan.tables.lake import TelemetryTables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DAY_AGO = AS_OF - timedelta(hours=24)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_ROOT") or tempfile.mkdtemp(prefix="bench-")
    spark = session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries: dict[str, float] = {}

    lake = TelemetryTables(spark, f"{root}/lake")
    feed = measurements(spark, SF_DIR)
    texts = [F.col(name).cast("string").alias(name) for name in FEED_FIELDS]
    fields = feed.select(*texts)
    in_last_day = F.col("when_captured") >= DAY_AGO.isoformat(sep=" ")
    write_ndjson(fields.filter(~in_last_day), f"{root}/feed-history")
    write_ndjson(fields.filter(in_last_day), f"{root}/feed-newest")

    def load(name: str, version: int) -> None:
        lake.load(positioned(scan_ndjson(spark, f"{root}/{name}")), version, AS_OF)

    queries["load_history"] = timed(lambda: load("feed-history", 1))
    queries["refresh"] = timed(lambda: load("feed-newest", 2))

    queries["rebuild"] = timed(lambda: lake.rebuild(3, AS_OF))

    facts, hourly, daily = lake.facts(), lake.hourly(), lake.daily()
    week = (AS_OF - timedelta(days=5), AS_OF)
    year = (datetime(2023, 6, 1), AS_OF)

    plans = {
        "empty_job": lambda: spark.range(1),
        "published_stats_panel": lambda: panels.stats_panel(lake.hourly(since=DAY_AGO), AS_OF),
        "published_latest": lake.latest,
        "raw_basic_stats": lambda: panels.basic_stats(facts),
        "raw_last_24h": lambda: panels.device_agg_24h(facts, AS_OF),
        "raw_last_7d_by_day": lambda: panels.daily_activity_7d(facts, AS_OF),
        "raw_country_agg": lambda: panels.country_agg(facts),
        "raw_count_all": lambda: panels.count_all(facts),
        "raw_series_range": lambda: panels.fact_series_range(facts, FROM, TO),
        "raw_anomalies_zscore": lambda: panels.anomalies_zscore(facts, FROM, TO),
        "raw_device_uptime": lambda: panels.device_uptime(facts, FROM, TO),
        "raw_latest_by_device": lambda: latest_by_device(facts),
        "raw_recent_detail": lambda: panels.recent_detail(facts, *week),
        "rollup_radiation_over_time": lambda: panels.radiation_over_time(hourly, FROM, TO, DEVICES),
        "rollup_all_devices_24h": lambda: panels.all_devices_24h(hourly, AS_OF),
        "rollup_device_list": lambda: panels.device_list_latest(hourly, AS_OF),
        "rollup_geo_distribution": lambda: panels.geo_distribution(hourly, AS_OF),
        "rollup_map_positions": lambda: map_latest_positions(hourly, DAY_AGO),
        "rollup_stats_panel": lambda: panels.stats_panel(hourly, AS_OF),
        "rollup_daily_series": lambda: panels.yearly_series(daily, *year, DEVICES),
    }
    for name, plan in plans.items():
        drain(plan())
        queries[name] = statistics.median(timed(lambda: drain(plan())) for _ in range(RUNS))

    answer = {
        "metric": "sum of medians of the headline queries, builds included",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in queries.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(answer))
    spark.stop()


if __name__ == "__main__":
    main()
