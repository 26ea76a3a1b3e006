"""Layouts that let scans skip files, joins that leave the held side where it lies, exports and backups."""

from __future__ import annotations

import glob
import json
import os
import shutil
import uuid
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspan.operators import filters as flt
from sensorspan.operators.filters import TIME
from sensorspan.plans.ingest import ingest
from sensorspan.schema import MEASUREMENT_COLUMNS
from sensorspan.sinks import exports, layout
from sensorspan.tables import backup
from sensorspan.tables.bucketed import BucketedFacts
from sensorspan.tables.slots import Slots

from .feeds import feed, rows_of

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    """20 days of readings of 300 devices in 20 countries that have nothing to do with their names."""
    rows = spark.range(30_000)
    return rows.select(
        F.concat(F.lit("d:"), F.lpad(((F.col("id") * 7919) % 300).cast("string"), 4, "0")).alias("device_urn"),
        F.concat(F.lit("C"), F.lpad(((F.col("id") * 104729) % 20).cast("string"), 2, "0")).alias("loc_country"),
        F.timestamp_add("MINUTE", (F.col("id") * 31) % (20 * 24 * 60), F.lit("2024-01-01").cast("timestamp_ntz")).alias("when_captured"),
        F.col("id").alias("device"),
    ).cache()


def opened(path: str, column: str, value: str) -> float:
    """The share of files whose range of a column has a value."""
    hits = total = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.read_metadata(file)
        at = meta.schema.names.index(column)
        ranges = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        total += 1
        hits += any(str(s.min) <= value <= str(s.max) for s in ranges)
    return hits / total


def test_interleaved_files_serve_every_filter(spark, facts, tmp_path):
    one, all_ = str(tmp_path / "clustered"), str(tmp_path / "interleaved")
    ordered = facts.withColumn("day", F.to_date("when_captured"))
    ordered.repartitionByRange(64, "day", "device_urn").write.parquet(one)
    layout.write_interleaved(facts, all_, files=64)
    assert rows_of(spark.read.parquet(all_).drop("day"), *facts.columns) == rows_of(facts, *facts.columns)
    for column, value, share in (("loc_country", "C07", 0.5), ("device_urn", "d:0123", 0.5), ("day", "2024-01-09", 0.65)):
        assert opened(all_, column, value) < share, column
    assert opened(one, "loc_country", "C07") == 1.0 and opened(one, "device_urn", "d:0123") > 0.2


def test_interleaving_of_nulls_equal_values_and_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, None), (None, "x", "2024-01-01")] * 5, "device_urn string, loc_country string, at string")
    rows = rows.select("device_urn", "loc_country", F.col("at").cast("timestamp_ntz").alias("when_captured"))
    for n, frame in enumerate((rows, rows.limit(0))):
        layout.write_interleaved(frame, str(tmp_path / str(n)))
        schema = T.StructType([*frame.schema.fields, T.StructField("day", T.DateType())])
        assert spark.read.schema(schema).parquet(str(tmp_path / str(n))).count() == frame.count()


def test_a_relation_of_keys(spark, facts, tmp_path):
    path = str(tmp_path / "facts")
    facts.orderBy("device").repartitionByRange(16, "device").write.parquet(path)
    rows = spark.read.parquet(path)
    keys = spark.range(5_000, 1_005_000).select(F.col("id").alias("k"))  # a million
    got = flt.in_relation(rows, "device", keys, "k")
    assert got.count() == 25_000
    plan = got._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and len(plan) < 20_000 and " IN (" not in plan
    nulls = spark.createDataFrame([(None,), (7,), (7,)], "k long")
    assert rows_of(flt.in_relation(rows, "device", nulls, "k"), "device") == [(7,)]
    assert flt.in_relation(rows, "device", keys.limit(0), "k").count() == 0
    some = flt.lookup(rows, device=keys, loc_country="C07", device_urn=None)
    assert some.count() == rows.where("device >= 5000 and loc_country = 'C07'").count()


def test_a_relation_of_keys_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "sorted")
    spark.range(100_000).repartitionByRange(20, "id").write.parquet(path)
    got = flt.in_relation(spark.read.parquet(path), "id", spark.range(10, 20).withColumnRenamed("id", "k"), "k")
    assert got.count() == 10
    scan = next(line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line)
    assert scan.lower().count("subquery") >= 2  # the least and the greatest key, known before the scan


@pytest.fixture()
def plain_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_held_facts_are_not_shuffled(spark, tmp_path, plain_joins):
    objects = [{"device": str(d), "device_urn": f"fixed:{d}", "when_captured": (START + timedelta(hours=h)).isoformat() + "Z"} for d in (1, 1, 2) for h in range(0, 60, 7)]
    rows = ingest(feed(spark, *objects), START).select(*MEASUREMENT_COLUMNS).cache()
    name = f"held_{uuid.uuid4().hex}"
    table = BucketedFacts(spark, name, str(tmp_path / "held"), buckets=4)
    assert rows_of(table.unmatched(rows)) == rows_of(rows)  # nothing is held yet
    table.insert_or_ignore(rows.where("day(when_captured) < 3").withColumn("pos", F.lit(0)), ["pos"])
    held = table.facts().count()
    fresh = table.unmatched(rows)
    assert rows_of(fresh) == rows_of(rows.where("day(when_captured) >= 3"))
    lines = fresh._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above = [line for i, line in enumerate(lines[:at]) if depth(line) < depth(lines[at]) and not any(depth(x) <= depth(line) for x in lines[i + 1 : at])]
    join = next(i for i, line in enumerate(above) if "Join" in line and "LeftAnti" in line)
    assert not [line for line in above[join:] if "Exchange" in line], above
    again = rows.withColumn("bat_voltage", F.lit("9")).unionByName(rows)
    keyless = rows.limit(1).withColumn("device", F.lit(None).cast("long"))
    table.insert_or_ignore(again.unionByName(keyless).withColumn("pos", F.when(F.col("bat_voltage") == "9", 1).otherwise(0)), ["pos"])
    assert held < table.facts().count() == rows.count()
    assert rows_of(table.facts(), *MEASUREMENT_COLUMNS) == rows_of(rows)
    assert table.unmatched(keyless).count() == 1


def test_an_export_touches_only_the_devices_that_reported(spark, tmp_path):
    path = str(tmp_path / "export")

    def readings(devices, hour, **more):
        objects = [{"device": str(d), "device_urn": f"fixed:{d}", "when_captured": f"2024-01-01T{hour:02d}:00:00Z", **more} for d in devices]
        return ingest(feed(spark, *objects), START).select(*MEASUREMENT_COLUMNS)

    exports.update_per_device(readings(range(100), 1), path)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.json", recursive=True)}
    exports.update_per_device(readings([7], 2).unionByName(readings([7], 1, bat_voltage="9")), path)
    after = set(glob.glob(f"{path}/**/*.json", recursive=True))
    assert set(before) <= after
    slots = {f.split("slot=")[1].split("/")[0] for f in after - set(before)}
    assert len(slots) == 1
    schema = T.StructType([*readings([1], 1).schema.fields, T.StructField("device_file", T.StringType())])
    held = exports.held_per_device(spark, path, schema)
    assert held.count() == 101 and held.where("bat_voltage = '9'").count() == 0
    folder = exports.device_folder(spark, path, "fixed:7")
    lines = [json.loads(x) for f in sorted(glob.glob(f"{folder.removeprefix('file:')}/*.json")) for x in open(f)]
    assert [x["when_captured"][:13] for x in lines] == ["2024-01-01T02", "2024-01-01T01"]
    assert exports.held_per_device(spark, str(tmp_path / "none"), schema) is None


def test_backup_into_the_same_and_a_changed_schema(spark, tmp_path):
    path = str(tmp_path / "backup")
    rows = spark.createDataFrame(
        [(1, "7", 2.5, "2024-01-01 00:00:00.000001", "a"), (300, "x", 3.0, None, None), (None, None, None, "1999-12-31 23:59:59", "")],
        "n long, t string, d double, at string, gone string",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    backup.write_backup(rows, path)
    assert rows_of(backup.restore(spark, path, rows.schema)) == rows_of(rows)
    (tmp_path / "backup" / "rows" / "more.json").write_text('{"n": 5, "t"\n')
    changed = T.StructType([T.StructField("number", T.ByteType()), T.StructField("t", T.LongType()), T.StructField("d", T.LongType()), T.StructField("at", T.DateType()), T.StructField("new", T.StringType())])
    renamed = {"number": "n"}
    got = backup.restore(spark, path, changed, renamed)
    assert got.schema.simpleString() == changed.simpleString()
    day = lambda *d: datetime(*d).date()
    assert rows_of(got) == sorted([(1, 7, None, day(2024, 1, 1), None), (None, None, 3, None, None), (None, None, None, day(1999, 12, 31), None)], key=repr)
    report = rows_of(backup.restore_report(spark, path, changed, renamed))
    assert report == sorted([("torn", "", 1), ("unfit", "number", 1), ("unfit", "t", 1), ("unfit", "d", 1), ("added", "new", 3), ("dropped", "gone", 2)], key=repr)


def test_an_export_of_held_readings_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "export")
    objects = [{"device": str(d), "device_urn": f"fixed:{d}", "when_captured": "2024-01-01T01:00:00Z"} for d in range(40)]
    rows = ingest(feed(spark, *objects), START).select(*MEASUREMENT_COLUMNS)
    exports.update_per_device(rows, path)
    files = lambda: set(glob.glob(f"{path}/**/*.json", recursive=True))
    before = files()
    exports.update_per_device(rows.withColumn("bat_voltage", F.lit("9")), path)
    assert files() == before
    # A merge that died left a device's folder of the version that the next one writes.
    left = next(iter(before)).rsplit("/", 3)[0]
    os.makedirs(f"{left}/version=3/device_file=ghost")
    shutil.copy(next(iter(before)), f"{left}/version=3/device_file=ghost/part.json")
    exports.update_per_device(rows.withColumn(TIME, F.col(TIME) + F.expr("INTERVAL 1 HOUR")), path)
    schema = T.StructType([*rows.schema.fields, T.StructField("device_file", T.StringType())])
    assert exports.held_per_device(spark, path, schema).count() == 80


def test_many_files_of_devices_are_listed_and_written_in_steps(spark, tmp_path, monkeypatch):
    """No step opens more files than the limit; all steps of an export are seen together, and none of one that died."""
    monkeypatch.setattr(exports, "FILES_AT_ONCE", 12)
    path, opened, put = str(tmp_path / "export"), [], []
    objects = [{"device": str(d), "device_urn": f"fixed:{d}", "when_captured": "2024-01-01T01:00:00Z"} for d in range(40)]
    rows = ingest(feed(spark, *objects), START).select(*MEASUREMENT_COLUMNS)
    later = rows.withColumn(TIME, F.col(TIME) + F.expr("INTERVAL 1 HOUR"))
    schema = T.StructType([*rows.schema.fields, T.StructField("device_file", T.StringType())])
    listed, write = Slots._files, Slots._put

    def files(self, chosen):
        opened.append(sum(len(glob.glob(f"{path}/slot={slot}/version={v}/*")) for slot, v in chosen))
        return listed(self, chosen)

    def putting(self, version, changed, touched):
        put.append(changed.select("device_file").distinct().count())
        if len(put) == 6:
            raise RuntimeError("died")
        write(self, version, changed, touched)

    monkeypatch.setattr(Slots, "_files", files)
    monkeypatch.setattr(Slots, "_put", putting)
    exports.update_per_device(rows, path)
    with pytest.raises(RuntimeError):
        exports.update_per_device(later, path)
    assert rows_of(exports.held_per_device(spark, path, schema), *MEASUREMENT_COLUMNS) == rows_of(rows)
    exports.update_per_device(later.limit(30).unionByName(rows), path)
    exports.update_per_device(later, path)
    exports.update_per_device(later, path)
    assert rows_of(exports.held_per_device(spark, path, schema), *MEASUREMENT_COLUMNS) == rows_of(rows.unionByName(later))
    assert max(opened) <= 12 and max(put) <= 12 and len(put) > 8
