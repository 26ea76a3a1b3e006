"""Streams with state: bounds, late and torn rows, restarts, and the size of the state."""

from __future__ import annotations

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorspan.operators.latest import latest_by_device
from sensorspan.operators.rollups import daily_summary, hourly_summary
from sensorspan.plans.ingest import ingest
from sensorspan.schema import MEASUREMENT_COLUMNS
from sensorspan.streaming import jobs, stateful

from .feeds import PLAIN, feed, rows_of

@pytest.fixture(autouse=True)
def few_stores(spark):
    """A state store for each of two partitions is enough here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


NOW = datetime(2024, 3, 1)
BOUND = timedelta(days=2)


def reading(when: datetime, device: int = 1, **fields) -> dict:
    own = {"device": str(device), "device_urn": f"fixed:{device}", "when_captured": when.isoformat() + "Z"}
    return {**own, **fields}


def land(folder, n: int, objects, *lines: str) -> None:
    folder.mkdir(exist_ok=True)
    path = folder / f"feed-{n:03d}.json"
    texts = [json.dumps({**PLAIN, **changed}) for changed in objects]
    path.write_text("\n".join([*texts, *lines]) + "\n")
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, folder):
    return jobs.read_feed(spark, str(folder), files_per_batch=1)


def progress(query) -> list[dict]:
    return [state for p in query.recentProgress for state in p["stateOperators"]]


START = datetime(2024, 1, 1)


def feeds(n: int, seed: int = 1):
    """Feeds of an hour each; readings come up to a day late, and some again in a later feed."""
    draw, sent = random.Random(seed), []
    for i in range(n):
        own = [
            reading(START + timedelta(hours=i - draw.randrange(24), minutes=draw.randrange(60)), draw.randrange(5), lnd_7318u=str(draw.randrange(90)))
            for _ in range(6)
        ]
        unique = {(o["device"], o["when_captured"]): o for o in own}
        # A repeat is the same reading: it has the values that were sent first.
        first = {(o["device"], o["when_captured"]): o for o in reversed(sent)}
        own = [first.get(key, o) for key, o in unique.items()]
        yield own + draw.sample(sent[-30:], min(3, len(sent)))
        sent += own


def batch(spark, *all_objects):
    rows: dict = {}
    for o in (o for objects in all_objects for o in objects):
        rows.setdefault((o["device"], o["when_captured"]), o)
    return ingest(feed(spark, *rows.values()), NOW).select(*MEASUREMENT_COLUMNS)


def test_once_each_within_the_bound(spark, tmp_path):
    """Torn lines, the future, missing devices and times, late rows and a restart: no row is lost."""
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    sent = [*feeds(12)]
    late = [reading(START - timedelta(days=20)), reading(START - timedelta(days=9), 2)]
    for n, objects in enumerate(sent[:6]):
        land(folder, n, objects, *(['{"device": "9", "when_ca', "nonsense"] if n == 2 else []))
    land(folder, 0, [*sent[0], reading(datetime(2080, 1, 9))])
    stateful.stream_dedupe(stream(spark, folder), out, checkpoint, NOW, BOUND).awaitTermination()
    half = stateful.facts(spark, out).count()
    land(folder, 6, [*late, *late, reading(START, device_urn="x", device="abc"), reading(START, when_captured="soon")])
    for n, objects in enumerate(sent[6:]):
        land(folder, n + 7, objects)
    query = stateful.stream_dedupe(stream(spark, folder), out, checkpoint, NOW, BOUND)
    query.awaitTermination()

    facts = stateful.facts(spark, out).select(*MEASUREMENT_COLUMNS)
    assert 0 < half < facts.count()
    assert rows_of(facts) == rows_of(batch(spark, *sent))
    kinds = {r["kind"]: r["count"] for r in stateful.set_aside(spark, out).groupBy("kind").count().collect()}
    assert kinds == {"torn": 2, "future": 1, "late": 4, "keyless": 1, "timeless": 1}
    assert rows_of(stateful.set_aside(spark, out).where("kind = 'torn'"), "line") == [("nonsense",), ('{"device": "9", "when_ca',)]
    assert rows_of(stateful.late_readings(spark, out), "device") == [(1,), (2,)]
    assert sum(s["numRowsDroppedByWatermark"] for s in progress(query)) <= 4


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"
    sent = [*feeds(4)]
    for n, objects in enumerate(sent):
        land(folder, n, objects)

    def run():
        stateful.stream_dedupe(stream(spark, folder), out, str(checkpoint), NOW, BOUND).awaitTermination()

    run()
    before = rows_of(stateful.facts(spark, out))
    last = max(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    (checkpoint / "commits" / str(last)).unlink()
    (checkpoint / "commits" / f".{last}.crc").unlink(missing_ok=True)
    run()
    assert rows_of(stateful.facts(spark, out)) == before


@pytest.mark.parametrize("name", ["hour", "day"])
def test_windows_equal_the_batch_and_their_state_stays_small(spark, tmp_path, name):
    """50 feeds over weeks: windows older than the bound leave the state, not the table."""
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    sent = [*feeds(50 if name == "hour" else 12, seed=2)]
    step = timedelta(hours=12)  # two feeds a day, so that the bound passes many times
    sent = [[{**o, "when_captured": _moved(o, i, step)} for o in objects] for i, objects in enumerate(_own(sent))]
    for n, objects in enumerate(sent):
        land(folder, n, [*objects, *objects[:2]], *(["{torn"] if n % 9 == 0 else []))
    land(folder, 1, [*sent[1], reading(datetime(2080, 1, 9))])

    def run():
        query = stateful.stream_windows(stream(spark, folder), out, checkpoint, name, NOW, BOUND)
        query.awaitTermination()
        return progress(query)

    sizes = [s["numRowsTotal"] for s in run()]
    facts = batch(spark, *sent)
    expected = hourly_summary(facts, NOW, days=90) if name == "hour" else daily_summary(facts)
    assert rows_of(stateful.read_windows(spark, out, name)) == rows_of(expected)
    if name == "hour":
        assert max(sizes) < facts.count() / 3
    some = stateful.read_windows(spark, out, name, days=["2024-01-03"])
    assert rows_of(some) == rows_of(expected.where(F.to_date(name) == F.lit("2024-01-03")))
    land(folder, 60, sent[-1])  # all of it once more
    run()
    assert rows_of(stateful.read_windows(spark, out, name)) == rows_of(expected)


def _own(sent):
    """The feeds without what they repeat of others."""
    seen = set()
    for objects in sent:
        new = [o for o in objects if (o["device"], o["when_captured"]) not in seen]
        seen.update((o["device"], o["when_captured"]) for o in new)
        yield new


def _moved(o, i, step):
    when = datetime.fromisoformat(o["when_captured"].rstrip("Z")) + i * (step - timedelta(hours=1))
    return when.isoformat() + "Z"


def test_newest_in_any_order(spark, tmp_path):
    """Years late and in any order, with equal times, and with a state that forgets at once."""
    draw = random.Random(1)
    objects = [
        reading(START - timedelta(days=draw.randrange(1000)), draw.randrange(6), lnd_7318u=str(draw.randrange(9)), loc_lat=draw.choice(["1.5", "2.5", "x"]))
        for _ in range(60)
    ]
    objects += [{**objects[0], "lnd_7318u": "8888888888888888888"}, reading(START, 77, lnd_7318u="z")]
    draw.shuffle(objects)
    for silence in (timedelta(days=30), timedelta(milliseconds=1)):
        folder, out = tmp_path / f"in-{silence.days}", str(tmp_path / f"out-{silence.days}")
        for n in range(4):
            land(folder, n, [*objects[n::4], reading(datetime(2080, 1, 9), 3)], "{torn")
        stateful.stream_newest(stream(spark, folder), out, out + "-cp", NOW, silence).awaitTermination()
        facts = ingest(feed(spark, *objects), NOW).select(*MEASUREMENT_COLUMNS)
        assert rows_of(stateful.read_newest(spark, out)) == rows_of(latest_by_device(facts))


def test_state_has_a_row_for_many_devices(spark, tmp_path):
    """Python is called for each bucket of devices, not for each device; null columns are least, and repeats change nothing."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    objects = [reading(START, device) for device in range(2000)]
    more = [reading(START + timedelta(hours=device % 2 - 1), device, lnd_7318u="77", loc_lat="x") for device in range(0, 2000, 7)]
    land(folder, 0, objects)
    land(folder, 1, [*more, *objects[:50], *objects[:50]])
    query = stateful.stream_newest(stream(spark, folder), out, out + "-cp", NOW)
    query.awaitTermination()
    assert [s["numRowsTotal"] for s in progress(query)][-1] <= stateful.STATE_BUCKETS < 2000
    facts = ingest(feed(spark, *objects, *more), NOW).select(*MEASUREMENT_COLUMNS)
    assert rows_of(stateful.read_newest(spark, out)) == rows_of(latest_by_device(facts))


def test_silent_devices_leave_the_state(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    for n in range(4):
        land(folder, n, [reading(START + timedelta(hours=n), device) for device in (n, n + 10)])
    query = stateful.stream_newest(stream(spark, folder), out, out + "-cp", NOW, timedelta(milliseconds=1))
    query.awaitTermination()
    assert [s["numRowsTotal"] for s in progress(query)][-1] <= 2
    assert stateful.read_newest(spark, out).count() == 8


def test_only_touched_buckets_are_written(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    land(folder, 0, [reading(START, device) for device in range(40)])
    land(folder, 1, [reading(START + timedelta(hours=1), 7)])
    stateful.stream_newest(stream(spark, folder), out, out + "-cp", NOW).awaitTermination()
    versions = [p for p in (tmp_path / "out").glob("slot=*/version=*")]
    assert sum(p.name == "version=1" for p in versions) == 1


def test_state_lies_in_a_few_stores_for_each_core(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    land(folder, 0, [reading(START, device) for device in range(5)])
    before = spark.conf.get(stateful.PARTITIONS)
    spark.conf.set(stateful.PARTITIONS, "40")
    try:
        query = stateful.stream_newest(stream(spark, folder), out, out + "-cp", NOW)
        query.awaitTermination()
        assert spark.conf.get(stateful.PARTITIONS) == "40"
    finally:
        spark.conf.set(stateful.PARTITIONS, before)
    cores = spark.sparkContext.defaultParallelism
    assert progress(query)[-1]["numShufflePartitions"] == min(40, stateful.STORES_PER_CORE * cores) < 40
    assert stateful.read_newest(spark, out).count() == 5


def test_a_batch_leaves_a_file_for_each_day_not_for_each_store(spark, tmp_path):
    sent = [reading(START + timedelta(days=n % 4, minutes=n), n) for n in range(80)]
    land(tmp_path / "landing", 0, [*sent, *sent])
    path = str(tmp_path / "bounded")
    stateful.stream_dedupe(stream(spark, tmp_path / "landing"), path, str(tmp_path / "checkpoint"), NOW, timedelta(days=30)).awaitTermination()
    assert stateful.facts(spark, path).count() == 80
    folders = [p.parent for p in (tmp_path / "bounded" / "batches").rglob("*.parquet")]
    assert len(set(folders)) == 4 and len(folders) == 4
