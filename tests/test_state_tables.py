"""What loads keep beside the facts: devices, moments, active devices; and what they set aside."""

from __future__ import annotations

import json
import random
import re
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorspan.operators import distinct
from sensorspan.operators.devices import device_slots, device_state, merge_devices
from sensorspan.operators.joins import device_radiation_stats
from sensorspan.operators.latest import latest_by_device
from sensorspan.operators.rollups import bucket_state, daily_summary, hourly_summary, radiation_moments
from sensorspan.plans import panels
from sensorspan.schema import MEASUREMENT_COLUMNS
from sensorspan.sources import feeds
from sensorspan.streaming.jobs import positioned
from sensorspan.tables import storage
from sensorspan.tables.lake import TelemetryTables
from sensorspan.tables.slots import Parts, Slots

from .feeds import PLAIN, feed, rows_of

AS_OF = datetime(2024, 3, 1)
START = datetime(2024, 1, 1)
FROM, TO = datetime(2024, 1, 2, 5, 30), datetime(2024, 1, 6, 17, 10)


def sent(n: int, seed: int, devices: int = 7) -> list[dict]:
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        device = draw.randrange(devices)
        when = START + timedelta(minutes=draw.randrange(9 * 24 * 60))
        out.append(
            {
                "device": str(device),
                "device_urn": f"fixed:{device}",
                "when_captured": when.isoformat() + "Z",
                "lnd_7318u": str(draw.choice([0, 0, 7, draw.randrange(100)])) if device else "5",
                "loc_country": draw.choice(["JP", "DE"]),
            }
        )
    return out


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    lake = TelemetryTables(spark, str(tmp_path_factory.mktemp("state") / "tables"), active=True)
    for batch in (3, 1, 2):
        lake.load(feed(spark, *sent(150, batch, 5 + batch)), batch, AS_OF)
    return lake


def test_devices_equal_a_pass_over_the_facts(loaded):
    facts = loaded.facts().select(*MEASUREMENT_COLUMNS).cache()
    assert rows_of(loaded.latest()) == rows_of(latest_by_device(facts))
    assert rows_of(loaded.latest(version=loaded.versions()[0])) == rows_of(latest_by_device(loaded.facts(loaded.versions()[0])))
    expected = device_state(facts).drop("number")
    assert rows_of(loaded.devices().select(*expected.columns)) == rows_of(expected)
    numbers = [r["number"] for r in loaded.devices().collect()]
    assert len(set(numbers)) == len(numbers)


def test_moments_equal_the_facts(loaded):
    facts = loaded.facts()
    close = lambda rows: [(k, pytest.approx(m, rel=1e-12), d if d is None else pytest.approx(d, rel=1e-12)) for k, m, d in rows]
    assert rows_of(loaded.radiation_stats()) == close(rows_of(device_radiation_stats(facts)))
    # A device whose counts are all equal has exactly no deviation.
    assert {r[0]: r[2] for r in loaded.radiation_stats().collect()}["fixed:0"] == 0.0


def test_moments_of_large_and_many_values(spark):
    draw = random.Random(3)
    rows = [(d, draw.choice([10**15 + draw.randrange(9), 3]) if d else 10**16) for d in (0, 1, 2) for _ in range(200)]
    rows += [(3, 9 * 10**18)] * 3 + [(4, 5), (5, -1), (5, 0)]
    frame = spark.createDataFrame(rows, "device_urn int, lnd_7318u long").withColumns({"env_temp": F.lit(1), "when_captured": F.lit("2024-01-01").cast("timestamp_ntz")})
    parts = [bucket_state(frame.where(f"lnd_7318u % 2 = {i}"), F.lit(i), "part", ["device_urn"]) for i in (0, 1)]
    got = {r[0]: tuple(r)[1:] for r in radiation_moments(parts[0].unionByName(parts[1]), "device_urn").collect()}
    for device in (1, 2):
        values = [v for d, v in rows if d == device]
        assert got[device] == (pytest.approx(statistics.mean(values), rel=1e-12), pytest.approx(statistics.stdev(values), rel=1e-9))
    assert got[0] == (1e16, 0.0) and got[4] == (5.0, None) and 5 not in got
    assert got[3][0] == 9e18  # its squares are past 38 digits, so there is no deviation
    assert got[3][1] is None


def scans(frame, table: str) -> list[str]:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "FileScan" in line and f"/{table}" in line]


def test_statistics_read_no_facts(loaded):
    assert scans(loaded.latest(), "measurements") == [] and scans(loaded.radiation_stats(), "measurements") == []
    found = panels.anomalies_zscore(loaded.facts(), FROM, TO, 0.5, loaded.radiation_stats())
    (scan,) = scans(found, "measurements")
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ >= 2024-01-02[^]]*day#\d+ <= 2024-01-06", scan)
    expected = panels.anomalies_zscore(loaded.facts(), FROM, TO, 0.5)
    rounded = lambda rows: [(*r[:3], round(r[3], 9), round(r[4], 9)) for r in rows]
    assert rounded(rows_of(found)) == rounded(rows_of(expected)) and found.count() > 10


@pytest.mark.parametrize("active", [True, False])
def test_ranges_from_state_equal_the_facts(spark, loaded, active):
    loaded = TelemetryTables(spark, loaded.root, active)
    facts = loaded.facts().select(*MEASUREMENT_COLUMNS)
    for frm, to in ((FROM, TO), (datetime(2024, 1, 3), datetime(2024, 1, 5)), (datetime(2024, 1, 3, 4), datetime(2024, 1, 3, 4, 50)), (datetime(2030, 1, 1), datetime(2030, 1, 2))):
        assert rows_of(loaded.device_uptime(frm, to)) == rows_of(panels.device_uptime(facts, frm, to))
        assert rows_of(loaded.hourly_active_devices(frm, to)) == rows_of(panels.hourly_active_devices(facts, frm, to))
        inside = facts.where(F.col("when_captured").between(F.lit(str(frm)).cast("timestamp_ntz"), F.lit(str(to)).cast("timestamp_ntz")))
        assert rows_of(loaded.device_count(frm, to)) == rows_of(inside.agg(F.count_distinct("device_urn")))
        by_country = inside.groupBy("loc_country").agg(F.count_distinct("device_urn"))
        assert rows_of(loaded.device_count(frm, to, "loc_country")) == rows_of(by_country)
        days = inside.groupBy(F.to_date("when_captured").alias("day")).agg(F.count("*"), F.count_distinct("device_urn"))
        assert rows_of(loaded.daily_activity(frm, to)) == rows_of(days)


def test_only_the_ends_of_a_range_are_read(loaded):
    (scan,) = scans(loaded.device_uptime(FROM, TO), "measurements")
    assert "2024-01-02" in scan and "2024-01-06" in scan and "day#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_sketches_are_near(spark):
    rows = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("device_urn"), (F.col("id") % 24).alias("hour"))
    state = distinct.device_sketches(rows, "hour")
    (got,) = distinct.estimate_sketches(state).first()
    assert abs(got - 20_000) < 20_000 * 0.05
    # Merged state estimates like one pass over the rows.
    assert got == distinct.estimate_sketches(distinct.device_sketches(rows, F.lit(1).alias("all"))).first()[0]


def test_bitmaps_of_many_blocks(spark):
    rows = spark.range(100_000).select((F.col("id") * 7 % 70_000).alias("number"), (F.col("id") % 3).alias("key"))
    state = distinct.device_bitmaps(rows, "key")
    expected = rows.groupBy("key").agg(F.count_distinct("number"))
    assert rows_of(distinct.count_bitmaps(state, "key")) == rows_of(expected)
    assert distinct.count_bitmaps(state).first()[0] == rows.select("number").distinct().count()
    assert distinct.count_bitmaps(state.limit(0)).first()[0] == 0


def test_retention_and_rebuild_keep_state_right(spark, tmp_path):
    lake = TelemetryTables(spark, str(tmp_path / "tables"), active=True)
    early = [{"device": "90", "device_urn": "gone:90", "when_captured": "2024-01-01T01:00:00Z"}]
    lake.load(feed(spark, *sent(60, 1), *early), 1, AS_OF)
    numbers = {r["device_urn"]: r["number"] for r in lake.devices().collect()}
    lake.drop_before(date(2024, 1, 4), 2)

    def agrees():
        facts = lake.facts().select(*MEASUREMENT_COLUMNS)
        assert rows_of(lake.latest()) == rows_of(latest_by_device(facts))
        rows = device_state(facts).drop("number")
        assert rows_of(lake.devices().select(*rows.columns)) == rows_of(rows)
        assert lake.device_count(START, AS_OF).first()[0] == facts.select("device_urn").distinct().count()
        assert rows_of(lake.hourly_active_devices(START, AS_OF)) == rows_of(panels.hourly_active_devices(facts, START, AS_OF))

    agrees()
    assert "gone:90" not in {r["device_urn"] for r in lake.devices().collect()}
    lake.rebuild(3, AS_OF)
    agrees()
    lake.load(feed(spark, *sent(40, 9, 12)), 2, AS_OF)
    agrees()
    now = {r["device_urn"]: r["number"] for r in lake.devices().collect()}
    assert all(now[d] == n for d, n in numbers.items() if d in now) and len(set(now.values())) == len(now)


def test_a_load_that_dies_leaves_the_state_of_the_last(spark, tmp_path, monkeypatch):
    lake = TelemetryTables(spark, str(tmp_path / "tables"))
    lake.load(feed(spark, *sent(30, 1)), 1, AS_OF)
    before = rows_of(lake.devices())
    publish = TelemetryTables._publish
    monkeypatch.setattr(TelemetryTables, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("dies")))
    for n in (2, 3):
        with pytest.raises(RuntimeError):
            lake.load(feed(spark, *sent(30, n, 20)), n, AS_OF)
        assert rows_of(lake.devices()) == before
    monkeypatch.setattr(TelemetryTables, "_publish", publish)
    lake.load(feed(spark, *sent(30, 2, 20)), 2, AS_OF)
    facts = lake.facts().select(*MEASUREMENT_COLUMNS)
    assert rows_of(lake.devices().drop("number")) == rows_of(device_state(facts).drop("number"))


def test_new_devices_are_numbered_after_the_held(spark):
    def state(*devices):
        return device_slots(device_state(_facts(spark, devices)))

    empty = device_state(_facts(spark, [])).limit(0)
    first = merge_devices(empty, state(*range(300))).drop("slot").cache()
    both = merge_devices(first, state(*range(250, 600)))
    old, new = ({r["device_urn"]: r["number"] for r in rows.collect()} for rows in (first, both))
    assert len(set(new.values())) == 600 and all(new[d] == n for d, n in old.items())


def _facts(spark, devices):
    rows = [(f"d{d}", f"2024-01-01 00:{d % 60:02d}:00") for d in devices]
    base = spark.createDataFrame(rows, "device_urn string, at string")
    from sensorspan.schema import MEASUREMENTS

    columns = {f.name: F.lit(None).cast(f.dataType) for f in MEASUREMENTS.fields if f.name not in ("device_urn", "when_captured")}
    return base.withColumns({**columns, "when_captured": F.col("at").cast("timestamp_ntz")}).select(*MEASUREMENT_COLUMNS)


# What is set aside --------------------------------------------------------------


def test_torn_lines_become_no_readings(spark, tmp_path):
    lines = [json.dumps({**PLAIN, **o}) for o in sent(5, 4)] + ['{"device": "1", "when_capt', "]", json.dumps({**PLAIN, "device": "x"})]
    path = tmp_path / "feed.json"
    path.write_text("\n".join(lines) + "\n")
    lake = TelemetryTables(spark, str(tmp_path / "tables"))
    report = lake.load(positioned(feeds.scan_audited(spark, str(path))), 1, AS_OF)
    assert (report["fetched"], report["valid"], report["quarantined"], report["new"]) == (8, 6, 3, 5)
    assert rows_of(lake.quarantine(), "reason", "line") == [("keyless", None), ("torn", "]"), ("torn", '{"device": "1", "when_capt')]
    assert "0" not in {r["device_urn"] for r in lake.facts().collect()}


def test_batches_in_any_order(spark, tmp_path):
    lake = TelemetryTables(spark, str(tmp_path / "tables"))
    parts = {n: sent(10, n) for n in (2401301205, 2401301200, 2401301210)}
    for n, objects in parts.items():
        assert not lake.load(feed(spark, *objects), n, AS_OF)["skipped"]
    assert all(lake.load(feed(spark, *objects), n, AS_OF)["skipped"] for n, objects in parts.items())
    assert lake.facts().count() == len({(o["device"], o["when_captured"]) for p in parts.values() for o in p})


def test_hours_are_kept_for_less_long(spark, tmp_path):
    lake = TelemetryTables(spark, str(tmp_path / "tables"))
    lake.load(feed(spark, *sent(80, 1)), 1, AS_OF)
    lake.drop_hours_before(date(2024, 1, 5), 2)

    def agrees():
        facts = lake.facts().select(*MEASUREMENT_COLUMNS)
        assert rows_of(lake.hourly()) == rows_of(hourly_summary(facts, AS_OF, days=90).where("hour >= '2024-01-05'"))
        assert rows_of(lake.daily()) == rows_of(daily_summary(facts))

    agrees()
    lake.load(feed(spark, *sent(80, 2)), 2, AS_OF)
    agrees()
    lake.rebuild(4, AS_OF)
    agrees()


# Slots -----------------------------------------------------------------------------


def test_slots(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame(rows, "k int, v int").withColumn("slot", (F.col("k") % 3).cast("string"))
    table = Slots(spark, str(tmp_path / "slots"), frame((0, 0)).drop("slot").schema)
    add = lambda held, changed: held.withColumn("slot", (F.col("k") % 3).cast("string")).unionByName(changed)
    assert table.read().count() == 0
    table.merge(1, frame((0, 1), (1, 1), (2, 1)), add)
    table.merge(2, frame((3, 2)), add)
    assert rows_of(table.read()) == [(0, 1), (1, 1), (2, 1), (3, 2)] and rows_of(table.read(upto=1)) == [(0, 1), (1, 1), (2, 1)]
    table.merge(2, frame((3, 2)), add)  # again, as after a crash
    assert rows_of(table.read()) == [(0, 1), (1, 1), (2, 1), (3, 2)]
    table.merge(3, frame((6, 3)), add, without={2})
    assert rows_of(table.read(without={2}, slots={"0"})) == [(0, 1), (6, 3)]
    table.replace(4, frame((9, 4)), {"0", "1"})
    assert rows_of(table.read()) == [(2, 1), (9, 4)]
    assert len(storage.matches(spark, str(tmp_path / "slots/slot=0/version=*"))) <= 2


def test_merges_rewrite_only_small_parts(spark, tmp_path):
    """Newer rows replace older ones, null keys too, and rows in large parts are not written again."""
    root = str(tmp_path / "parts")
    frame = lambda *rows: spark.createDataFrame(rows, "k int, v int").withColumn("slot", F.lit("a"))
    table = Parts(spark, root, frame((0, 0)).drop("slot").schema, ["k"])
    assert table.read().count() == 0
    held, sizes = {}, []
    for version in range(1, 17):
        rows = {100 + version: version, version % 3: version, None: version}
        held.update(rows)
        for _ in range(2 if version in (4, 7) else 1):  # again, as after a crash
            table.merge(version, frame(*rows.items()))
        assert rows_of(table.read()) == sorted(held.items(), key=repr)
        sizes.append(spark.read.parquet(f"{root}/slot=a/version={version}").count())
    assert sizes[-1] == len(held) and sum(sizes) < 16 * 5 * 2 and sizes[::2] == [3] * 8
    assert len(storage.matches(spark, f"{root}/slot=a/version=*")) <= 6
    table.merge(17, frame((500, 1)))
    table.merge(18, frame((501, 1)), without={17})
    assert rows_of(table.read(without={17}, slots={"a"})) == sorted({**held, 501: 1}.items(), key=repr)
    storage.delete(spark, f"{root}/parts")  # as tables without parts were
    table.merge(19, frame((0, 19)))
    assert {r["k"]: r["v"] for r in table.read().collect()}[0] == 19
