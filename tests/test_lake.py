"""The published tables: repeats, late rows, versions, retention."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sensorspan.operators.latest import latest_by_device
from sensorspan.operators.rollups import daily_summary, hourly_summary
from sensorspan.schema import MEASUREMENT_COLUMNS
from sensorspan.tables import lake as lake_module
from sensorspan.tables.lake import TelemetryTables

from .feeds import feed, rows_of

AS_OF = datetime(2024, 1, 6, 12)


def at(day: int, hour: int, **fields) -> dict:
    return {"when_captured": f"2024-01-{day:02d}T{hour:02d}:20:00Z", **fields}


def second_device(**fields) -> dict:
    return {"device": "2", "device_urn": "fixed:2", "device_sn": "65002", **fields}


FIRST = [at(4, 9), at(5, 10), at(5, 10, **second_device()), at(5, 11, lnd_7318u="60.0")]
SECOND = [
    at(5, 11, lnd_7318u="1.0"),  # held already
    at(6, 8),
    at(3, 7, **second_device()),  # late, on a day without a bucket
    at(5, 10, loc_lat="36.0", device="3", device_urn="fixed:1"),  # the device moved
    at(6, 9, device="abc"),  # no key
    {"when_captured": "2080-01-09T00:00:00Z"},
]


@pytest.fixture()
def lake(spark, root):
    lake = TelemetryTables(spark, root)
    lake.load(feed(spark, *FIRST), 1, AS_OF)
    return lake


def agrees_with_full_rebuild(lake):
    facts = lake.facts().select(*MEASUREMENT_COLUMNS)
    assert rows_of(lake.hourly()) == rows_of(hourly_summary(facts, AS_OF))
    assert rows_of(lake.daily()) == rows_of(daily_summary(facts))


def test_load_reports_and_publishes(spark, lake):
    report = lake.load(feed(spark, *SECOND), 2, AS_OF)
    counts = {k: report[k] for k in ("fetched", "valid", "quarantined", "new", "total")}
    assert counts == {"fetched": 6, "valid": 6, "quarantined": 2, "new": 3, "total": 7}
    assert lake.versions() == [1, 2]
    assert lake.facts().count() == 7
    assert rows_of(lake.quarantine(), "device") == [(1,), (None,)]


def test_incremental_equals_full_rebuild(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    agrees_with_full_rebuild(lake)
    lake.rebuild(3, AS_OF)
    agrees_with_full_rebuild(lake)


def test_moving_device_has_a_row_per_position(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    hour = lake.hourly().filter("device_urn = 'fixed:1' and hour = timestamp_ntz'2024-01-05 10:00:00'")
    assert rows_of(hour, "loc_lat") == [(35.5,), (36.0,)]


def test_daily_counts_sum_to_the_facts(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    assert lake.daily().agg(F.sum("reading_count")).first()[0] == lake.facts().count()


def test_loading_the_same_feed_again_adds_nothing(spark, lake):
    before = rows_of(lake.facts()), rows_of(lake.hourly())
    assert lake.load(feed(spark, *FIRST), 2, AS_OF)["new"] == 0
    assert (rows_of(lake.facts()), rows_of(lake.hourly())) == before


def test_a_published_version_is_not_loaded_again(spark, lake):
    assert lake.load(feed(spark, *SECOND), 1, AS_OF)["skipped"]
    assert lake.facts().count() == 4


def test_older_version_stays_readable(spark, lake):
    before = rows_of(lake.facts()), rows_of(lake.hourly()), rows_of(lake.daily())
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    assert (rows_of(lake.facts(1)), rows_of(lake.hourly(1)), rows_of(lake.daily(1))) == before


def test_a_load_that_dies_is_invisible_and_can_be_repeated(spark, lake, monkeypatch):
    before = rows_of(lake.facts()), rows_of(lake.hourly())
    monkeypatch.setattr(
        TelemetryTables, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    )
    with pytest.raises(RuntimeError):
        lake.load(feed(spark, *SECOND), 2, AS_OF)
    assert (rows_of(lake.facts()), rows_of(lake.hourly())) == before
    monkeypatch.undo()
    report = lake.load(feed(spark, *SECOND), 2, AS_OF)
    assert (report["new"], report["total"]) == (3, 7)
    agrees_with_full_rebuild(lake)


def test_a_dead_load_stays_invisible_to_the_next(spark, lake, monkeypatch):
    """The feed after a load that died is another one; facts, rollups and totals agree."""
    with monkeypatch.context() as patch:
        patch.setattr(TelemetryTables, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lake.load(feed(spark, *SECOND), 2, AS_OF)
    lake.load(feed(spark, at(6, 10)), 3, AS_OF)
    total = lake.facts().count()
    assert total == 5 == lake.sync_state().first().total_rows
    assert lake.daily().agg(F.sum("reading_count")).first()[0] == total
    agrees_with_full_rebuild(lake)
    # What died is brought in when it comes again.
    lake.load(feed(spark, *SECOND), 4, AS_OF)
    assert lake.facts().count() == 8
    agrees_with_full_rebuild(lake)
    lake.compact([date(2024, 1, 5), date(2024, 1, 6)])
    assert lake.facts().count() == 8


def test_used_numbers_are_refused(spark, lake):
    for call in (lambda: lake.rebuild(1, AS_OF), lambda: lake.drop_before(date(2024, 1, 5), 1)):
        with pytest.raises(ValueError, match="used already"):
            call()
    with pytest.raises(ValueError, match="nothing is published"):
        TelemetryTables(spark, lake.root + "-other").rebuild(1, AS_OF)


def test_a_load_reads_only_new_facts_and_the_state_of_their_days(spark, lake, monkeypatch):
    read = []
    of = TelemetryTables._state_days
    monkeypatch.setattr(TelemetryTables, "_state_days", lambda self, t, days: read.extend(days) or of(self, t, days))
    monkeypatch.setattr(TelemetryTables, "refresh", None)
    lake.load(feed(spark, at(5, 13)), 2, AS_OF)
    assert {day for day, _ in read} == {date(2024, 1, 5)}
    agrees_with_full_rebuild(lake)


def test_the_first_by_raw_device_wins(spark, root):
    """Two devices without a number share one key: the lesser raw name is the first, wherever it stands."""
    lake = TelemetryTables(spark, root)
    rows = [at(5, 10, device=None, device_urn="z:9"), at(5, 10, device=None, device_urn="a:1")]
    lake.load(feed(spark, *rows), 1, AS_OF)
    assert rows_of(lake.facts(), "device_urn") == [("a:1",)]


def test_future_rows_do_not_move_the_watermark(spark, lake):
    soon = at(6, 20)  # after as_of, within a day: kept, but no watermark
    report = lake.load(feed(spark, {"when_captured": "2080-01-09T00:00:00Z"}, soon), 2, AS_OF)
    assert report["new"] == 1
    assert lake.sync_state().first().last_sync_timestamp == datetime(2024, 1, 5, 11, 20)


def test_expire_keeps_what_newer_versions_use(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    lake.load(feed(spark, at(6, 10)), 3, AS_OF)
    want = rows_of(lake.hourly()), rows_of(lake.daily())
    assert lake.expire(keep=1) == [3]
    assert (rows_of(lake.hourly()), rows_of(lake.daily())) == want
    with pytest.raises(Exception, match="(?i)path|exist"):
        lake.hourly(1).count()


def test_retention_drops_whole_days(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    lake.drop_before(date(2024, 1, 5), 3)
    assert rows_of(lake.facts().select("day").distinct()) == [(date(2024, 1, 5),), (date(2024, 1, 6),)]
    agrees_with_full_rebuild(lake)
    assert lake.sync_state().first().total_rows == lake.facts().count()


def test_compaction_changes_no_row(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    before = rows_of(lake.facts()), rows_of(lake.facts(1))
    lake.compact([date(2024, 1, 5)])
    assert (rows_of(lake.facts()), rows_of(lake.facts(1))) == before


def test_recent_is_a_slice_of_the_facts(spark, lake):
    assert rows_of(lake.recent(AS_OF, days=1), "when_captured") == []
    assert lake.recent(AS_OF, days=2).count() == 3


def test_latest_reads_only_last_days(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    newest = lake.latest()
    assert rows_of(newest) == rows_of(latest_by_device(lake.facts()))
    plan = newest._jdf.queryExecution().executedPlan().toString()
    pruned = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any("day" in p and "2024-01-05" in p and "2024-01-03" not in p for p in pruned), plan


def test_range_opens_only_its_days(spark, lake):
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    day = lake.hourly(since=datetime(2024, 1, 5), until=datetime(2024, 1, 5, 23))
    assert {f.split("day=")[1][:10] for f in day.inputFiles()} == {"2024-01-05"}
    assert day.count() == 4


def test_nothing_published(spark, root):
    with pytest.raises(ValueError, match="nothing is published"):
        TelemetryTables(spark, root).facts()


def test_many_loads_of_a_day_do_not_rewrite_it_each_time(spark, lake, monkeypatch):
    """Of a day that every load touches, a load reads what stands for no more loads than itself has merged."""
    read = []
    of = TelemetryTables._state_days
    monkeypatch.setattr(TelemetryTables, "_state_days", lambda self, t, days: read.append((t, len(days))) or of(self, t, days))
    for number in range(2, 6):
        lake.load(feed(spark, at(5, 10 + number)), number, AS_OF)
    assert sorted(n for t, n in read if t == "daily_summary") == [0, 0, 1, 2]
    agrees_with_full_rebuild(lake)
    assert rows_of(lake.daily(), "reading_count")[-1] == (6,)
    monkeypatch.undo()
    lake.expire(keep=1)
    agrees_with_full_rebuild(lake)


def test_held_readings_sent_again_rewrite_no_state(spark, lake):
    report = lake.load(feed(spark, *FIRST), 2, AS_OF)
    assert (report["new"], report["total"]) == (0, 4)
    assert {parts for parts in lake._manifest(2).values()} == {((1, 1),)}
    agrees_with_full_rebuild(lake)


def test_state_of_new_days_is_made_once_for_all_tables(spark, root, monkeypatch):
    """Days without held state are not merged, and active devices come from the hourly state, not from the facts again."""
    merged, found = [], []
    of, merge = TelemetryTables._active_of, lake_module.merge_state
    monkeypatch.setattr(lake_module, "merge_state", lambda state, bucket, name: merged.append(name) or merge(state, bucket, name))

    def spied(self, *args):
        made = of(self, *args)
        found.append(made._jdf.queryExecution().optimizedPlan().toString())
        return made

    monkeypatch.setattr(TelemetryTables, "_active_of", spied)
    lake = TelemetryTables(spark, root, active=True)
    lake.load(feed(spark, *FIRST), 1, AS_OF)
    assert merged == []
    assert "InMemoryRelation" in found[0]
    lake.load(feed(spark, *SECOND), 2, AS_OF)
    assert sorted(merged) == ["day", "hour"]
    monkeypatch.undo()
    agrees_with_full_rebuild(lake)
    frm, to = datetime(2024, 1, 3, 7, 10), datetime(2024, 1, 6, 8, 50)
    hours = lake.facts().groupBy(F.date_trunc("hour", "when_captured").cast("timestamp_ntz").alias("time"))
    assert rows_of(lake.hourly_active_devices(frm, to)) == rows_of(hours.agg(F.count_distinct("device_urn")))


def test_hourly_state_of_a_small_load_has_few_partitions(spark, root, monkeypatch):
    """The merges of a load read as many partitions as its rows ask for, not as many as a shuffle may have."""
    seen = []
    of = TelemetryTables._merge
    monkeypatch.setattr(TelemetryTables, "_merge", lambda self, hours, *rest: seen.append(hours.rdd.getNumPartitions()) or of(self, hours, *rest))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        lake = TelemetryTables(spark, root)
        lake.load(feed(spark, *FIRST), 1, AS_OF)
        lake.load(feed(spark, *SECOND), 2, AS_OF)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 2 and max(seen) < 20
    agrees_with_full_rebuild(lake)


def test_a_small_load_does_not_shuffle_the_held_keys(spark, lake, monkeypatch):
    plans = []
    of = lake_module.insert_or_ignore

    def spied(*args, **named):
        rows = of(*args, **named)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(lake_module, "insert_or_ignore", spied)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = lake.load(feed(spark, *SECOND), 2, AS_OF)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert report["new"] == 3
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in plans[0].splitlines())
    agrees_with_full_rebuild(lake)
