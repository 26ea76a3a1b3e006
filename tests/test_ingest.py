"""Golden rows for the cleaning and dedupe rules."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorspan.operators.dedupe import (
    insert_or_ignore,
    merge_history,
    split_keyed,
    unmatched,
    upsert,
)
from sensorspan.plans.ingest import ingest
from sensorspan.sources import feeds as sources

from .feeds import feed, rows_of

BATCH = datetime(2024, 1, 6, 9, 30, 1)
NOON = datetime(2024, 1, 5, 10, 15)


def typed(spark, *objects):
    return ingest(feed(spark, *objects), BATCH)


@pytest.mark.parametrize("bad", ["2012-00-00T00:00:00Z", "2024-11", "soon"])
def test_bad_time_drops_the_row(spark, bad):
    assert typed(spark, {"when_captured": bad}).count() == 0


@pytest.mark.parametrize("missing", ["", None])
def test_missing_time_is_the_batch_time(spark, missing):
    assert typed(spark, {"when_captured": missing}).first().when_captured == BATCH


@pytest.mark.parametrize(
    ("field", "text", "want"),
    [
        ("device", None, 0),
        ("device", "abc", None),
        ("device", "21.7", 22),
        ("device", "22.5", 23),
        ("device", "1e3", 1000),
        ("lnd_7318u", "21.7", 22),
        ("lnd_7318u", "22.5", 22),
        ("lnd_7318u", "21.5", 22),
        ("lnd_7318u", None, 0),
        ("lnd_7318u", "", 0),
        ("env_temp", "hot", None),
        ("loc_lat", "", 0.0),
        ("loc_lat", "x", None),
        ("loc_name", None, "0"),
        ("loc_name", "", ""),
        ("bat_voltage", None, "0"),
        ("bat_voltage", "", "0"),
        ("bat_voltage", "4.1", "4.1"),
        ("pms_pm02_5", None, "0"),
    ],
)
def test_field_rules(spark, field, text, want):
    assert typed(spark, {field: text}).first()[field] == want


@pytest.mark.parametrize(
    ("urn", "name"),
    [
        ("fixed:1", "fixed_1.json"),
        ('a:"b', "a__b.json"),
        (None, "unknown_device.json"),
        ("", "unknown_device.json"),
        ("0", "unknown_device.json"),
    ],
)
def test_file_name(spark, urn, name):
    assert typed(spark, {"device_urn": urn}).first().device_filename == name


def test_mixed_json_values_are_read_as_text(spark, tmp_path):
    path = tmp_path / "feed.json"
    path.write_text('[{"bat_voltage": 0, "loc_lat": 1.5}, {"bat_voltage": "3.7"}, {"bat_voltage": 4.1}]')
    read = sources.scan_json_array(spark, str(path))
    assert rows_of(read, "bat_voltage") == [("0",), ("3.7",), ("4.1",)]


def test_broken_lines_are_skipped_and_counted(spark, tmp_path):
    path = tmp_path / "feed.ndjson"
    path.write_text('{"device": "1"}\n{"device": "2\n{"device": "3"}\n')
    assert rows_of(sources.scan_tolerant(spark, str(path)), "device") == [("1",), ("3",)]
    audited = sources.scan_audited(spark, str(path))
    broken = [r for r in audited.select("device", "_corrupt_record").collect() if r[1]]
    assert len(broken) == 1


def test_first_object_of_a_device_and_time_wins(spark):
    out = typed(spark, {"lnd_7318u": "1"}, {"lnd_7318u": "2"}, {"device_urn": "fixed:2"})
    assert rows_of(out, "device_urn", "lnd_7318u") == [("fixed:1", 1), ("fixed:2", 30)]


def test_missing_names_and_times_are_one_group(spark):
    blank = {"device_urn": None, "when_captured": None}
    assert typed(spark, blank, {**blank, "lnd_7318u": "9"}).first().lnd_7318u == 30


def test_held_rows_win_over_new_ones(spark):
    held = typed(spark, {"lnd_7318u": "7"}).drop("pos")
    batch = typed(spark, {"lnd_7318u": "8"}, {"device": "2", "device_urn": "fixed:2"})
    assert rows_of(insert_or_ignore(batch, held, ["pos"]), "device") == [(2,)]


def test_rows_without_a_key_never_match(spark):
    rows = typed(spark, {"device": "abc"}, {"device": "2", "device_urn": "fixed:2"}).drop("pos")
    assert rows_of(unmatched(rows, rows), "device_urn") == [("fixed:1",)]


def test_rows_unfit_for_the_table_are_split_off(spark):
    rows = typed(
        spark,
        {},
        {"device": "abc", "device_urn": "x:1"},
        {"when_captured": "2080-01-09T00:00:00Z", "device_urn": "x:2"},
    )
    fit, unfit = split_keyed(rows, BATCH)
    assert rows_of(fit, "device_urn") == [("fixed:1",)]
    assert rows_of(unfit, "device_urn") == [("x:1",), ("x:2",)]


def test_upsert_replaces_and_inserts(spark):
    held = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, n int")
    out = upsert(held.withColumn("n", F.lit(0)), new, ["k"], ["n"])
    assert rows_of(out, "k", "v") == [(1, "a"), (2, "d"), (3, "e")]


def test_history_keeps_what_it_holds(spark):
    held = typed(spark, {"lnd_7318u": "7"}).drop("pos")
    new = typed(spark, {"lnd_7318u": "8"}, {"device_urn": "fixed:2"}).drop("pos")
    merged = merge_history(held, new, ["lnd_7318u"])
    assert rows_of(merged, "device_urn", "lnd_7318u") == [("fixed:1", 7), ("fixed:2", 30)]


def test_legacy_points(spark):
    points = spark.createDataFrame(
        [("139.7449", "35.6617", "49", "60", "cpm", "111")],
        "longitude string, latitude string, device_id string, value string, unit string, height string",
    )
    row = ingest(sources.from_legacy_points(points).withColumn("pos", F.lit(0)), BATCH).first()
    assert (row.device, row.lnd_7318u, row.loc_lat, row.when_captured) == (49, 60, 35.6617, BATCH)
