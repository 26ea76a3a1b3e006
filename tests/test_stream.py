"""Streams over several batches, late rows, and restarts."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest

from sensorspan.operators.latest import latest_by_device
from sensorspan.operators.rollups import daily_summary, hourly_summary
from sensorspan.plans.ingest import ingest
from sensorspan.schema import CORRUPT, MEASUREMENT_COLUMNS
from sensorspan.streaming import jobs
from sensorspan.tables import lake as lake_module
from sensorspan.tables.lake import TelemetryTables

from .feeds import PLAIN, feed, rows_of
from .test_lake import FIRST, SECOND, at, second_device

AS_OF = datetime(2024, 1, 6, 12)
THIRD = [at(2, 5), at(4, 9, lnd_7318u="2.0"), at(6, 11, **second_device(lnd_7318u="44.0"))]


def land(folder, n: int, objects) -> None:
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({**PLAIN, **changed}) for changed in objects]
    path = folder / f"feed-{n}.json"
    path.write_text("\n".join(lines) + "\n")
    # A stream takes files by their age; these were all written at once.
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing"
    for n, objects in enumerate((FIRST, SECOND, THIRD)):
        land(folder, n, objects)
    return folder


def stream(spark, folder):
    return jobs.read_feed(spark, str(folder), files_per_batch=1)


def test_publish_equals_batch(spark, landing, tmp_path, root):
    jobs.stream_publish(
        stream(spark, landing), root, str(tmp_path / "cp"), lambda: AS_OF
    ).awaitTermination()
    lake = TelemetryTables(spark, root)
    facts = lake.facts().select(*MEASUREMENT_COLUMNS)
    assert facts.count() == 9
    assert rows_of(facts.select("device", "when_captured").distinct()) == rows_of(
        facts, "device", "when_captured"
    )
    assert rows_of(lake.hourly()) == rows_of(hourly_summary(facts, AS_OF))
    assert rows_of(lake.daily()) == rows_of(daily_summary(facts))


def test_publish_goes_on_after_a_stop(spark, landing, tmp_path, root):
    checkpoint = str(tmp_path / "cp")

    def run():
        jobs.stream_publish(
            stream(spark, landing), root, checkpoint, lambda: AS_OF
        ).awaitTermination()

    run()
    lake = TelemetryTables(spark, root)
    versions = lake.versions()
    land(landing, 3, [at(6, 11), *FIRST])
    run()
    assert lake.versions() == [*versions, versions[-1] + 1]
    assert lake.facts().count() == 10
    run()
    assert lake.facts().count() == 10


def test_ingest_cleans_every_batch(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    jobs.stream_ingest(
        stream(spark, landing), out, str(tmp_path / "cp"), AS_OF
    ).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == len(FIRST) + len(SECOND) + len(THIRD)
    assert got.select("batch_id").distinct().count() == 3


def publish(spark, folder, tmp_path, root, clock=AS_OF):
    jobs.stream_publish(stream(spark, folder), root, str(tmp_path / "cp"), clock).awaitTermination()
    return TelemetryTables(spark, root)


FUTURE = {"when_captured": "2080-01-09T00:00:00Z"}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_repeats_the_future_and_lateness_lose_nothing(spark, tmp_path, root, zone):
    """A reading of 2080 comes first; then all batches, then all again, the last one years late."""
    folder = tmp_path / "landing"
    old = {"when_captured": "2013-05-01T10:00:00Z"}
    for n, objects in enumerate(([FUTURE], FIRST, SECOND, THIRD, FIRST, THIRD, [old])):
        land(folder, n, objects)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        lake = publish(spark, folder, tmp_path, root)
        facts = jobs.read_facts(spark, root).select(*MEASUREMENT_COLUMNS)
        hours, days = (jobs.read_rollup(spark, root, name) for name in ("hour", "day"))
        once = once_each(spark, old)
        assert rows_of(facts, "device", "when_captured") == rows_of(once, "device", "when_captured")
        assert rows_of(hours) == rows_of(hourly_summary(facts, datetime(2013, 5, 20)))
        assert rows_of(days) == rows_of(daily_summary(facts))
        assert rows_of(jobs.read_latest(spark, root)) == rows_of(latest_by_device(facts))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    # The future and the rows without a device are set aside each time they come, with a count.
    aside = sum(o.get("device") == "abc" or o == FUTURE for o in [FUTURE, *FIRST, *SECOND, *THIRD, *FIRST, *THIRD])
    assert lake.quarantine().count() == aside
    assert days.agg({"reading_count": "sum"}).first()[0] == lake.sync_state().first().total_rows == facts.count()


def once_each(spark, *more):
    """The distinct keys of all that can become a fact, batch by batch."""
    rows = ingest(feed(spark, *FIRST), AS_OF)
    for batch in (SECOND, THIRD, more):
        rows = rows.unionByName(ingest(feed(spark, *batch), AS_OF))
    fit = rows.where("device is not null and when_captured < timestamp_ntz'2030-01-01 00:00:00'")
    return fit.select("device", "when_captured").distinct()


def test_a_clock_for_each_batch(spark, tmp_path, root):
    """Readings without a time are told apart by the batches they came in."""
    folder = tmp_path / "landing"
    for n in range(2):
        land(folder, n, [{"when_captured": ""}])
    times = iter([datetime(2024, 1, 6, 12), datetime(2024, 1, 6, 13)])
    lake = publish(spark, folder, tmp_path, root, lambda: next(times))
    assert rows_of(lake.facts(), "when_captured") == [(datetime(2024, 1, 6, 12),), (datetime(2024, 1, 6, 13),)]


def test_a_stream_after_a_load_and_another_stream(spark, landing, tmp_path, root):
    """Batch numbers of different sources do not hide each other."""
    lake = TelemetryTables(spark, root)
    lake.load(feed(spark, at(1, 1)), 40, AS_OF)
    publish(spark, landing, tmp_path / "first", root)
    assert lake.facts().count() == 10
    other = tmp_path / "other"
    land(other, 0, [at(2, 2)])
    publish(spark, other, tmp_path / "second", root)
    assert lake.facts().count() == 11
    assert lake.load(feed(spark, at(2, 3)), 40, AS_OF)["skipped"]
    assert not lake.load(feed(spark, at(2, 3)), 41, AS_OF)["skipped"]
    assert lake.facts().count() == 12


def test_the_older_file_wins(spark, tmp_path, root):
    """Files count by age, whatever their size."""
    folder = tmp_path / "landing"
    land(folder, 0, [at(5, 10, lnd_7318u="1.0")])
    land(folder, 1, [at(5, 10, lnd_7318u="2.0"), *(at(5, 11, device=str(n)) for n in range(10, 400))])
    rows = jobs.positioned(spark.read.schema(jobs.FEED).json(str(folder)))
    TelemetryTables(spark, root).load(rows, 1, AS_OF)
    kept = TelemetryTables(spark, root).facts().where("hour(when_captured) = 10")
    assert rows_of(kept, "lnd_7318u") == [(1,)]


def test_feeds_without_torn_lines_are_parsed_once_and_typed_in_short_methods(spark, tmp_path, root, monkeypatch):
    """Only a feed with torn lines is read again for them; each load has its own limit of a method's size."""
    folder, seen, limits = tmp_path / "landing", [], []
    land(folder, 0, [at(1, 1)])
    land(folder, 1, [at(2, 1)])
    (folder / "torn.json").write_text('{"device": "5", "when_captu')
    aside, changing = TelemetryTables._set_aside, lake_module.settings

    def setting_aside(self, feed, unfit, version):
        seen.append(CORRUPT in feed.columns)
        return aside(self, feed, unfit, version)

    def settings(session, **changed):
        limits.append(changed)
        return changing(session, **changed)

    monkeypatch.setattr(TelemetryTables, "_set_aside", setting_aside)
    monkeypatch.setattr(lake_module, "settings", settings)
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    lake = publish(spark, folder, tmp_path, root)
    assert sorted(seen) == [False, False, True]
    assert rows_of(lake.quarantine(), "reason", "line") == [("torn", '{"device": "5", "when_captu')]
    assert limits == [{"spark.sql.codegen.hugeMethodLimit": "8000"}] * 3 and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
    assert lake.facts().count() == 2
