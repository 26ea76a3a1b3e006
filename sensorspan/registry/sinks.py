"""Sinks and table maintenance. Each query writes, and returns what a reader
then finds."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import materialise, scratch_path
from ..functions.timebuckets import hour_of, moment
from ..operators import distinct
from ..operators.filters import TIME, last
from ..operators.joins import join_device_stats
from ..operators.rollups import daily_summary, hourly_summary, radiation_moments, recent_data
from ..operators.tables import empty_clone, row_counts, roundtrip_check
from ..plans import panels
from ..schema import FEED_FIELDS, MEASUREMENT_COLUMNS, MEASUREMENTS
from ..sinks import exports, layout
from ..sources import feeds, tables
from ..tables import backup
from ..tables.lake import TelemetryTables
from .aggregates import DEVICE_STATS_SQL
from .core import (
    AS_OF,
    FEED_FROM,
    FROM,
    HELD_UNTIL,
    TO,
    daily,
    measurements,
    query,
    rounded,
    sql_rounded,
    sql_with,
    ts,
)

# The hourly rollup is kept for less long than the daily one.
RETAIN_HOURS_FROM = date(2024, 1, 16)
# A range that begins and ends inside an hour.
ODD_FROM, ODD_TO = FROM + timedelta(minutes=25), TO + timedelta(minutes=10)
DAY_AGO = AS_OF - timedelta(hours=24)
LAST_DAY = f"when_captured >= {ts(DAY_AGO)}"


def _with(schema: T.StructType, partition: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(partition, T.StringType())])


# Tables ----------------------------------------------------------------------


@query("sink_full_refresh", sql_with("SELECT * FROM h", "h"))
def sink_full_refresh(spark, sf):
    """A stale rollup, then its full replacement."""
    path = scratch_path(spark, "full-refresh")
    facts = measurements(spark, sf)
    stale = hourly_summary(facts.filter(F.col(TIME) < moment(HELD_UNTIL)), AS_OF)
    exports.write_parquet(stale, path)
    exports.write_parquet(hourly_summary(facts, AS_OF), path)
    return spark.read.parquet(path)


def _table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


@query("sink_ctas", sql_with("SELECT * FROM d", "d"))
def sink_ctas(spark, sf):
    name = _table("daily_summary")
    for _ in range(2):
        daily(spark, sf).write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


@query(
    "sink_replace_copy",
    sql_with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {view}"
            for name, view in (
                ("measurements", "m"),
                ("hourly_summary", "h"),
                ("recent_data", "r"),
                ("daily_summary", "d"),
            )
        ),
        "m",
        "h",
        "r",
        "d",
    ),
)
def sink_replace_copy(spark, sf):
    """All four tables copied to another root, over what was there."""
    source, dest = scratch_path(spark, "copy-source"), scratch_path(spark, "copy-dest")
    facts = measurements(spark, sf)
    frames = {
        "measurements": facts,
        "hourly_summary": hourly_summary(facts, AS_OF),
        "recent_data": recent_data(facts, AS_OF),
        "daily_summary": daily_summary(facts),
    }
    for name, df in frames.items():
        df.write.parquet(f"{source}/{name}")
    for _ in range(2):
        tables.copy_tables(spark, source, dest, frames)
    return row_counts({name: spark.read.parquet(f"{dest}/{name}") for name in frames})


@query("sink_empty_clone", sql_with("SELECT * FROM m WHERE 1 = 0", "m"))
def sink_empty_clone(spark, sf):
    return empty_clone(measurements(spark, sf))


_SHARED: dict[tuple[str, str], str] = {}


def _shared(spark, sf) -> TelemetryTables:
    """The tables after two loads, loaded once per application for all readers."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SHARED:
        _SHARED[key] = _loaded(spark, sf, "shared", active=True).root
    return TelemetryTables(spark, _SHARED[key], active=True)


def _loaded(spark, sf, name: str, active: bool = False) -> TelemetryTables:
    """The tables after two loads: held readings, then a feed that overlaps
    them and brings readings from long before."""
    lake = TelemetryTables(spark, scratch_path(spark, name), active)
    facts = measurements(spark, sf)
    late = F.col("lnd_7128ec") != "0"
    sent = facts.select(
        *[F.col(c).cast("string").alias(c) for c in FEED_FIELDS],
        F.lit(0).alias("pos"),
        late.alias("late"),
        F.col(TIME).alias("at"),
    )
    feed = materialise(sent, f"{name}-feed")
    first = feed.filter((F.col("at") < moment(HELD_UNTIL)) & ~F.col("late"))
    second = feed.filter((F.col("at") >= moment(FEED_FROM)) | F.col("late"))
    lake.load(first, 1, AS_OF)
    lake.load(second, 2, AS_OF)
    return lake


@query("sink_partition_replace", sql_with("SELECT * FROM h", "h"))
def sink_partition_replace(spark, sf):
    """The hourly rollup after only the touched days were replaced."""
    return _shared(spark, sf).hourly()


@query("sink_partition_replace_daily", sql_with("SELECT * FROM d", "d"))
def sink_partition_replace_daily(spark, sf):
    return _shared(spark, sf).daily()


@query(
    "scan_snapshot",
    sql_with(
        f"SELECT * FROM m WHERE when_captured < {ts(HELD_UNTIL)} AND lnd_7128ec = '0'", "m"
    ),
)
def scan_snapshot(spark, sf):
    """The facts as of the first load, read after the second."""
    return _shared(spark, sf).facts(version=1).select(*MEASUREMENT_COLUMNS)


@query(
    "publish_snapshot",
    sql_with(
        "SELECT CAST(1 AS BIGINT) AS version, COUNT(*) AS facts, CAST((SELECT COUNT(*) FROM (SELECT"
        " DISTINCT date_trunc('hour', when_captured), device_urn FROM m WHERE when_captured <"
        f" {ts(HELD_UNTIL)} AND lnd_7128ec = '0')) AS BIGINT) AS hours FROM m"
        f" WHERE when_captured < {ts(HELD_UNTIL)} AND lnd_7128ec = '0'"
        " UNION ALL SELECT 2, COUNT(*), (SELECT COUNT(*) FROM (SELECT DISTINCT"
        " date_trunc('hour', when_captured), device_urn FROM m)) FROM m",
        "m",
    ),
)
def publish_snapshot(spark, sf):
    """What readers of each published version see."""
    lake = _shared(spark, sf)
    rows = F.count(F.lit(1))
    parts = [
        lake.facts(v)
        .agg(F.lit(v).cast("bigint").alias("version"), rows.alias("facts"))
        .withColumn("hours", lake.hourly(v).agg(rows).scalar())
        for v in lake.versions()
    ]
    return parts[0].unionByName(parts[1])


@query("expire_snapshots", sql_with("SELECT CAST(2 AS BIGINT) AS version, * FROM h", "h"))
def expire_snapshots(spark, sf):
    """The one version left after expiry still reads whole."""
    lake = _loaded(spark, sf, "expire")
    kept = lake.expire(keep=1)
    return lake.hourly(kept[0]).select(F.lit(kept[0]).cast("bigint").alias("version"), "*")


@query(
    "lake_sync_state",
    sql_with(
        "SELECT 'measurements' AS table_name, MAX(when_captured) AS last_sync_timestamp,"
        " COUNT(*) AS total_rows FROM m",
        "m",
    ),
)
def lake_sync_state(spark, sf):
    return _shared(spark, sf).sync_state()


@query(
    "lake_latest",
    sql_with(
        "SELECT DISTINCT ON (device_urn) device_urn, device_sn, loc_country, loc_name, loc_lat,"
        " loc_lon, lnd_7318u AS radiation, when_captured AS last_reading FROM m"
        " ORDER BY device_urn, when_captured DESC",
        "m",
    ),
)
def lake_latest(spark, sf):
    """Newest reading per device, from the table of devices that loads merge into."""
    return _shared(spark, sf).latest()


@query(
    "lake_latest_version",
    sql_with(
        "SELECT DISTINCT ON (device_urn) device_urn, device_sn, loc_country, loc_name, loc_lat,"
        " loc_lon, lnd_7318u AS radiation, when_captured AS last_reading FROM m"
        f" WHERE when_captured < {ts(HELD_UNTIL)} AND lnd_7128ec = '0'"
        " ORDER BY device_urn, when_captured DESC",
        "m",
    ),
)
def lake_latest_version(spark, sf):
    """The same as of the first load, by way of the daily rollup."""
    return _shared(spark, sf).latest(version=1)


@query(
    "lake_devices",
    sql_with(
        "SELECT device_urn, MIN(when_captured) AS first_reading, MAX(when_captured) AS last_reading,"
        " COUNT(*) AS reading_count, COUNT(*) FILTER (lnd_7318u > 0) AS positive_n,"
        " CAST(COALESCE(SUM(lnd_7318u) FILTER (lnd_7318u > 0), 0) AS BIGINT) AS positive_sum,"
        " CAST(COALESCE(SUM(lnd_7318u * lnd_7318u) FILTER (lnd_7318u > 0), 0) AS BIGINT) AS positive_squares"
        " FROM m GROUP BY device_urn",
        "m",
    ),
)
def lake_devices(spark, sf):
    """What the table of devices has after two loads."""
    rows = _shared(spark, sf).devices()
    whole = [F.col(c).cast("bigint").alias(c) for c in ("positive_sum", "positive_squares")]
    return rows.select("device_urn", "first_reading", "last_reading", "reading_count", "positive_n", *whole)


@query(
    "lake_join_stats",
    sql_rounded(
        sql_with(
            "SELECT m.device_urn, m.when_captured, m.lnd_7318u, s.avg_radiation,"
            " s.stddev_radiation FROM m JOIN s ON m.device_urn = s.device_urn"
            f" WHERE when_captured >= {ts(DAY_AGO)}",
            "m",
            s=DEVICE_STATS_SQL,
        ),
        "avg_radiation",
        "stddev_radiation",
    ),
)
def lake_join_stats(spark, sf):
    """Readings of the last day beside statistics of all time, which come from state."""
    lake = _shared(spark, sf)
    facts = last(lake.facts(), AS_OF, hours=24).select("device_urn", TIME, "lnd_7318u")
    return rounded(join_device_stats(facts, lake.radiation_stats()), "avg_radiation", "stddev_radiation")


@query(
    "lake_anomalies_zscore",
    sql_rounded(
        sql_with(
            "SELECT m.when_captured, m.device_urn, m.lnd_7318u, s.avg_radiation,"
            " (m.lnd_7318u - s.avg_radiation) / NULLIF(s.stddev_radiation, 0) AS z_score"
            " FROM m JOIN s ON m.device_urn = s.device_urn"
            " WHERE (m.lnd_7318u - s.avg_radiation) / NULLIF(s.stddev_radiation, 0) > 2"
            f" AND when_captured BETWEEN {ts(FROM)} AND {ts(TO)}",
            "m",
            s=DEVICE_STATS_SQL,
        ),
        "avg_radiation",
        "z_score",
    ),
)
def lake_anomalies_zscore(spark, sf):
    """Only facts of the range are read; means and deviations come from merged moments."""
    lake = _shared(spark, sf)
    found = panels.anomalies_zscore(lake.facts(), FROM, TO, stats=lake.radiation_stats())
    return rounded(found, "avg_radiation", "z_score")


@query(
    "lake_hourly_active",
    sql_with(
        "SELECT date_trunc('hour', when_captured) AS time, COUNT(DISTINCT device_urn) AS active_devices"
        f" FROM m WHERE when_captured BETWEEN {ts(ODD_FROM)} AND {ts(ODD_TO)} GROUP BY 1",
        "m",
    ),
)
def lake_hourly_active(spark, sf):
    """Distinct devices by hour from bitmaps; the range begins and ends inside an hour."""
    return _shared(spark, sf).hourly_active_devices(ODD_FROM, ODD_TO)


@query(
    "lake_device_count",
    sql_with(
        "SELECT COUNT(DISTINCT device_urn) AS device_count FROM m"
        f" WHERE when_captured BETWEEN {ts(ODD_FROM)} AND {ts(ODD_TO)}",
        "m",
    ),
)
def lake_device_count(spark, sf):
    return _shared(spark, sf).device_count(ODD_FROM, ODD_TO)


@query(
    "lake_geo_devices",
    sql_with(
        "SELECT loc_country, COUNT(DISTINCT device_urn) AS device_count FROM m"
        f" WHERE when_captured BETWEEN {ts(ODD_FROM)} AND {ts(ODD_TO)} GROUP BY loc_country",
        "m",
    ),
)
def lake_geo_devices(spark, sf):
    return _shared(spark, sf).device_count(ODD_FROM, ODD_TO, "loc_country")


@query("device_count_sketch")
def device_count_sketch(spark, sf):
    """Devices of each country from merged hourly sketches, beside the exact number."""
    facts = measurements(spark, sf, "device_urn", "loc_country", TIME)
    state = materialise(distinct.device_sketches(facts, hour_of(TIME).alias("hour"), "loc_country"), "sketches")
    exact = facts.groupBy("loc_country").agg(F.count_distinct("device_urn").alias("exact"))
    return distinct.estimate_sketches(state, "loc_country").join(exact, "loc_country")


@query(
    "lake_device_uptime",
    sql_with(
        "SELECT device_urn, MIN(when_captured) AS first_seen, MAX(when_captured) AS last_seen,"
        " COUNT(*) AS total_readings, (epoch_us(MAX(when_captured)) -"
        " epoch_us(MIN(when_captured))) / 1e6 / 86400 AS days_active FROM m"
        f" WHERE when_captured BETWEEN {ts(ODD_FROM)} AND {ts(ODD_TO)} GROUP BY device_urn",
        "m",
    ),
)
def lake_device_uptime(spark, sf):
    """Uptime from daily state, with facts of the two days at the range's ends."""
    return _shared(spark, sf).device_uptime(ODD_FROM, ODD_TO)


@query(
    "lake_daily_activity",
    sql_with(
        "SELECT CAST(when_captured AS DATE) AS day, COUNT(*) AS readings_per_day,"
        " COUNT(DISTINCT device_urn) AS active_devices FROM m"
        f" WHERE when_captured BETWEEN {ts(ODD_FROM)} AND {ts(ODD_TO)} GROUP BY 1",
        "m",
    ),
)
def lake_daily_activity(spark, sf):
    return _shared(spark, sf).daily_activity(ODD_FROM, ODD_TO)


@query(
    "state_moments",
    sql_rounded(
        sql_with(
            "SELECT loc_country, AVG(lnd_7318u) AS avg_radiation, STDDEV(lnd_7318u) AS stddev_radiation"
            f" FROM m WHERE lnd_7318u > 0 AND CAST(when_captured AS DATE) BETWEEN DATE '{FROM.date()}'"
            f" AND DATE '{TO.date()}' GROUP BY loc_country",
            "m",
        ),
        "avg_radiation",
        "stddev_radiation",
    ),
)
def state_moments(spark, sf):
    """Mean and deviation by country over a range of days, merged from the daily state."""
    state = _shared(spark, sf).daily_state(FROM, TO)
    return rounded(radiation_moments(state, "loc_country"), "avg_radiation", "stddev_radiation")


@query(
    "retention_hourly",
    sql_with(
        "SELECT 'hour' AS rollup, SUM(reading_count) AS readings, MIN(hour) AS first FROM h"
        f" WHERE hour >= DATE '{RETAIN_HOURS_FROM}' UNION ALL"
        " SELECT 'day', SUM(reading_count), MIN(day) FROM d",
        "h",
        "d",
    ).replace("SUM(reading_count)", "CAST(SUM(reading_count) AS BIGINT)"),
)
def retention_hourly(spark, sf):
    """Hours before a date go, also those of a late feed and of a rebuild; days stay whole."""
    lake = TelemetryTables(spark, scratch_path(spark, "retention-hourly"))
    texts = [F.col(c).cast("string").alias(c) for c in FEED_FIELDS]
    facts = measurements(spark, sf)
    late = F.col("lnd_7128ec") != "0"
    lake.load(facts.filter(~late).select(*texts, F.lit(0).alias("pos")), 1, AS_OF)
    lake.drop_hours_before(RETAIN_HOURS_FROM, 2)
    lake.load(facts.filter(late).select(*texts, F.lit(0).alias("pos")), 2, AS_OF)
    rows = F.sum("reading_count").alias("readings")
    hours = lake.hourly().agg(F.lit("hour").alias("rollup"), rows, F.min("hour").alias("first"))
    days = lake.daily().agg(F.lit("day").alias("rollup"), rows, F.min("day").cast("timestamp_ntz").alias("first"))
    return hours.unionByName(days)


@query("load_out_of_order", sql_with("SELECT * FROM m", "m"))
def load_out_of_order(spark, sf):
    """Feeds numbered by their time, the later one first; each is brought in once."""
    lake = TelemetryTables(spark, scratch_path(spark, "out-of-order"))
    texts = [F.col(c).cast("string").alias(c) for c in FEED_FIELDS]
    facts = measurements(spark, sf)
    early = F.col(TIME) < moment(HELD_UNTIL)
    for number, rows in ((20240120, ~early), (20240119, early), (20240119, early)):
        lake.load(facts.filter(rows).select(*texts, F.lit(0).alias("pos")), number, AS_OF)
    return lake.facts().select(*MEASUREMENT_COLUMNS)


@query(
    "sync_tables",
    sql_with("SELECT *, (SELECT CAST(SUM(reading_count) AS BIGINT) FROM d) AS rolled_up FROM m", "m", "d"),
)
def sync_tables(spark, sf):
    """Tables that held the first readings, brought up to another root's, late ones included."""
    lake = TelemetryTables(spark, scratch_path(spark, "synced"))
    early = measurements(spark, sf).filter(F.col(TIME) < moment(FEED_FROM))
    texts = [F.col(c).cast("string").alias(c) for c in FEED_FIELDS]
    lake.load(early.select(*texts, F.lit(0).alias("pos")), 1, AS_OF)
    other = _shared(spark, sf)
    lake.sync(other, AS_OF)
    if not lake.sync(other, AS_OF)["skipped"]:
        raise AssertionError("nothing is new the second time")
    rolled_up = lake.daily().agg(F.sum("reading_count")).scalar()
    return lake.facts().select(*MEASUREMENT_COLUMNS, rolled_up.alias("rolled_up"))


RETAIN_FROM = date(2024, 1, 11)


@query(
    "retention_partitions", sql_with(f"SELECT * FROM d WHERE day >= DATE '{RETAIN_FROM}'", "d")
)
def retention_partitions(spark, sf):
    """The daily rollup after whole days before a date were dropped."""
    lake = _loaded(spark, sf, "retention")
    lake.drop_before(RETAIN_FROM, version=3)
    lake.rebuild(4, AS_OF)
    return lake.daily()


@query("backup_table", sql_with("SELECT * FROM m", "m"))
def backup_table(spark, sf):
    """Lines of text as a backup, restored into the table's types."""
    path = scratch_path(spark, "backup")
    exports.write_ndjson(measurements(spark, sf), path)
    return feeds.scan_tolerant(spark, path, MEASUREMENTS)


# The changed table: a renamed, a widened, a narrowed and a retyped column, one more and some less.
CHANGED = T.StructType(
    [
        T.StructField("urn", T.StringType()),
        T.StructField("when_captured", T.TimestampNTZType()),
        T.StructField("lnd_7318u", T.DoubleType()),
        T.StructField("device", T.ShortType()),
        T.StructField("device_sn", T.LongType()),
        T.StructField("lnd_7318c", T.LongType()),
        T.StructField("altitude", T.DoubleType()),
    ]
)
RENAMED = {"urn": "device_urn"}
_WHOLE = "TRY_CAST(CASE WHEN regexp_matches(lnd_7318c, '^-?[0-9]+$') THEN lnd_7318c END AS BIGINT)"


@query(
    "backup_restore_changed",
    sql_with(
        "SELECT device_urn AS urn, when_captured, CAST(lnd_7318u AS DOUBLE) AS lnd_7318u,"
        " TRY_CAST(device AS SMALLINT) AS device, CAST(device_sn AS BIGINT) AS device_sn,"
        f" {_WHOLE} AS lnd_7318c, CAST(NULL AS DOUBLE) AS altitude FROM m",
        "m",
    ),
)
def backup_restore_changed(spark, sf):
    """A backup restored into a table whose columns have changed since."""
    path = scratch_path(spark, "backup-changed")
    backup.write_backup(measurements(spark, sf), path)
    return backup.restore(spark, path, CHANGED, RENAMED)


@query(
    "backup_restore_report",
    sql_with(
        "SELECT 'torn' AS what, '' AS name, CAST(1 AS BIGINT) AS rows"
        " UNION ALL SELECT 'added', 'altitude', COUNT(*) FROM m"
        f" UNION ALL SELECT 'unfit', 'lnd_7318c', COUNT(*) FROM m WHERE {_WHOLE} IS NULL HAVING COUNT(*) > 0"
        + "".join(
            f" UNION ALL SELECT 'dropped', '{c}', COUNT({c}) FROM m"
            for c in MEASUREMENT_COLUMNS
            if c not in ("device_urn", *CHANGED.names)
        ),
        "m",
    ),
)
def backup_restore_report(spark, sf):
    """What the changed table can't take over, of a backup with a torn line."""
    path = scratch_path(spark, "backup-report")
    backup.write_backup(measurements(spark, sf), path)
    spark.range(1).select(F.lit('{"device": 5, "dev').alias("value")).write.mode("append").text(f"{path}/rows")
    return backup.restore_report(spark, path, CHANGED, RENAMED)


@query(
    "migrate_roundtrip_check",
    sql_with(
        "SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, TRUE AS same_count,"
        " TRUE AS same_content FROM m",
        "m",
    ),
)
def migrate_roundtrip_check(spark, sf):
    path = scratch_path(spark, "migrate")
    facts = measurements(spark, sf)
    exports.write_parquet(facts, path)
    return roundtrip_check(facts, spark.read.parquet(path))


# Layout ----------------------------------------------------------------------


@query(
    "layout_clustered",
    sql_with(
        f"SELECT * FROM m WHERE when_captured BETWEEN {ts(FROM)} AND {ts(TO)}"
        " AND device_urn = 'mobile:1'",
        "m",
    ),
)
def layout_clustered(spark, sf):
    """A range of one device from the clustered table."""
    path = scratch_path(spark, "clustered")
    layout.write_clustered(measurements(spark, sf), path)
    rows = spark.read.parquet(path)
    inside = rows.filter(F.col("day").between(F.lit(FROM.date()), F.lit(TO.date())))
    return inside.filter(
        F.col(TIME).between(moment(FROM), moment(TO)) & (F.col("device_urn") == "mobile:1")
    ).select(*MEASUREMENT_COLUMNS)


@query(
    "layout_interleaved",
    sql_with(
        "SELECT 'country' AS path, COUNT(*) AS rows FROM m WHERE loc_country = 'NATION_7'"
        " UNION ALL SELECT 'device', COUNT(*) FROM m WHERE device_urn = 'mobile:1'"
        f" UNION ALL SELECT 'day', COUNT(*) FROM m WHERE CAST(when_captured AS DATE) = DATE '{TO.date()}'",
        "m",
    ),
)
def layout_interleaved(spark, sf):
    """Filters by country, device and day on one table, each of which skips files."""
    path = scratch_path(spark, "interleaved")
    layout.write_interleaved(measurements(spark, sf), path, files=32)
    rows = spark.read.parquet(path)
    filters = {
        "country": F.col("loc_country") == "NATION_7",
        "device": F.col("device_urn") == "mobile:1",
        "day": F.col("day") == F.lit(TO.date()),
    }
    parts = [rows.filter(f).agg(F.lit(name).alias("path"), F.count(F.lit(1)).alias("rows")) for name, f in filters.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("layout_by_year", sql_with("SELECT * FROM m WHERE year(when_captured) = 2024", "m"))
def layout_by_year(spark, sf):
    path = scratch_path(spark, "by-year")
    layout.write_by_year(measurements(spark, sf), path)
    return layout.scan_year(spark.read.parquet(path), 2024)


def _column_stats(name: str, ranged: bool) -> str:
    low, high = (f"CAST({f}({name}) AS VARCHAR)" if ranged else "NULL" for f in ("MIN", "MAX"))
    return (
        f"SELECT '{name}' AS col_name, CAST(COUNT(*) - COUNT({name}) AS VARCHAR) AS num_nulls,"
        f' {low} AS "min", {high} AS "max" FROM m'
    )


_RANGED = ("dev_temp", "device", "env_temp", "lnd_7318u", "loc_lat", "loc_lon", "when_captured")


@query(
    "table_stats",
    sql_with(
        " UNION ALL ".join(_column_stats(c, c in _RANGED) for c in MEASUREMENT_COLUMNS), "m"
    ),
)
def table_stats(spark, sf):
    """Nulls and extremes of each column."""
    return tables.column_statistics(measurements(spark, sf), _RANGED)


# Exports ---------------------------------------------------------------------


@query("sink_parquet", sql_with("SELECT * FROM m", "m"))
def sink_parquet(spark, sf):
    path = scratch_path(spark, "export-parquet")
    exports.write_parquet(measurements(spark, sf), path)
    return spark.read.parquet(path)


@query("sink_ndjson", sql_with("SELECT * FROM m", "m"))
def sink_ndjson(spark, sf):
    path = scratch_path(spark, "export-ndjson")
    exports.write_ndjson(measurements(spark, sf), path)
    return feeds.scan_ndjson(spark, path, MEASUREMENTS)


@query("sink_json_array", sql_with(f"SELECT * FROM m WHERE {LAST_DAY}", "m"))
def sink_json_array(spark, sf):
    path = scratch_path(spark, "export-array")
    exports.write_json_array(last(measurements(spark, sf), AS_OF, hours=24), path)
    return feeds.scan_json_array(spark, path, MEASUREMENTS)


@query(
    "sink_per_device_json",
    sql_with("SELECT *, replace(device_urn, ':', '_') AS device_file FROM m", "m"),
)
def sink_per_device_json(spark, sf):
    """History kept, new readings added, one folder per device."""
    path = scratch_path(spark, "export-devices")
    facts = measurements(spark, sf)
    held = facts.filter(F.col(TIME) < moment(HELD_UNTIL))
    incoming = facts.filter(F.col(TIME) >= moment(FEED_FROM))
    exports.write_per_device(exports.per_device_history(held, incoming), path)
    return spark.read.schema(_with(MEASUREMENTS, "device_file")).json(path)


@query(
    "sink_per_device_update",
    sql_with("SELECT *, replace(device_urn, ':', '_') AS device_file FROM m", "m"),
)
def sink_per_device_update(spark, sf):
    """The same files after three exports on top of each other, two of which overlap."""
    path = scratch_path(spark, "export-updated")
    facts = measurements(spark, sf)
    exports.update_per_device(facts.filter(F.col(TIME) < moment(HELD_UNTIL)), path)
    for _ in range(2):
        exports.update_per_device(facts.filter(F.col(TIME) >= moment(FEED_FROM)), path)
    return exports.held_per_device(spark, path, _with(MEASUREMENTS, "device_file"))


@query(
    "sink_sensor_feeds",
    sql_with(
        " UNION ALL ".join(
            f"SELECT *, '{name}' AS sensor FROM m WHERE {LAST_DAY} AND {condition}"
            for name, condition in (
                ("all", "TRUE"),
                ("air", "TRY_CAST(pms_pm02_5 AS DOUBLE) > 0"),
                ("radiation-7128ec", "TRY_CAST(lnd_7128ec AS DOUBLE) > 0"),
                ("radiation-7318u", "lnd_7318u > 0"),
                ("radiation-7318c", "TRY_CAST(lnd_7318c AS DOUBLE) > 0"),
            )
        ),
        "m",
    ),
)
def sink_sensor_feeds(spark, sf):
    path = scratch_path(spark, "export-sensors")
    exports.write_sensor_feeds(measurements(spark, sf), AS_OF, path)
    return spark.read.schema(_with(MEASUREMENTS, "sensor")).json(path)


@query(
    "sink_csv",
    sql_with(
        "SELECT device_urn, COUNT(*) AS measurement_count, MAX(when_captured) AS last_seen"
        " FROM m GROUP BY device_urn",
        "m",
    ),
)
def sink_csv(spark, sf):
    path = scratch_path(spark, "export-csv")
    counts = measurements(spark, sf, "device_urn", TIME).groupBy("device_urn")
    rows = counts.agg(F.count(F.lit(1)).alias("n"), F.max(TIME).alias("last_seen"))
    exports.write_csv(rows, path)
    schema = "device_urn string, measurement_count bigint, last_seen timestamp_ntz"
    return spark.read.schema(schema).csv(path)

