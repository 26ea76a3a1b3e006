"""Sources: feeds in their file formats, tables, catalogs, snapshots."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import scratch_path
from ..operators.filters import TIME
from ..operators.tables import row_counts
from ..plans.ingest import clean_feed, enforce_schema
from ..schema import FEED, FEED_FIELDS, LEGACY_POINT, LEGACY_WIDE, MEASUREMENTS
from ..sinks.exports import write_json_array, write_ndjson
from ..sources import feeds, tables
from .core import daily, hourly, measurements, query, raw_feed, recent, sql_with

FEED_LIST = ", ".join(FEED_FIELDS)


def _feed_sql(where: str = "TRUE", columns: str = FEED_LIST) -> str:
    return sql_with(f"SELECT {columns} FROM f WHERE {where}", "f")


@query("scan_json_array", _feed_sql())
def scan_json_array(spark, sf):
    path = scratch_path(spark, "feed-array")
    write_json_array(raw_feed(spark, sf).drop("pos"), path)
    return feeds.scan_json_array(spark, path)


@query("scan_ndjson", _feed_sql())
def scan_ndjson(spark, sf):
    path = scratch_path(spark, "feed-lines")
    write_ndjson(raw_feed(spark, sf).drop("pos"), path)
    return feeds.scan_ndjson(spark, path)


def _torn_lines(spark, sf) -> str:
    """Feed lines, of which those of devices named ``a:`` lack their last brace."""
    feed = raw_feed(spark, sf).drop("pos")
    line = F.to_json(F.struct("*"))
    torn = F.startswith(F.coalesce("device_urn", F.lit("")), F.lit("a:"))
    text = F.when(torn, F.regexp_replace(line, r"\}$", "")).otherwise(line)
    path = scratch_path(spark, "feed-torn")
    feed.select(text.alias("value")).write.text(path)
    return path


WHOLE = "device_urn IS NULL OR device_urn NOT LIKE 'a:%'"


@query("scan_json_tolerant", _feed_sql(WHOLE))
def scan_json_tolerant(spark, sf):
    return feeds.scan_tolerant(spark, _torn_lines(spark, sf))


@query(
    "scan_json_audited",
    sql_with(
        f"SELECT COUNT(*) FILTER ({WHOLE}) AS parsed, COUNT(*) FILTER (NOT ({WHOLE})) AS dropped,"
        f" COUNT(DISTINCT device_urn) FILTER ({WHOLE}) AS devices FROM f",
        "f",
    ),
)
def scan_json_audited(spark, sf):
    """How many lines parsed, how many did not, and the devices in the former."""
    audited = feeds.scan_audited(spark, _torn_lines(spark, sf))
    bad = F.col("_corrupt_record").isNotNull()
    return audited.agg(
        F.count_if(~bad).alias("parsed"),
        F.count_if(bad).alias("dropped"),
        F.count_distinct(F.when(~bad, F.col("device_urn"))).alias("devices"),
    )


@query("feed_template_projection", _feed_sql())
def feed_template_projection(spark, sf):
    """Feed lines with further fields, read by the template's schema."""
    path = scratch_path(spark, "feed-wide")
    wide = raw_feed(spark, sf).withColumn("dev_orient", F.lit("flat"))
    write_ndjson(wide, path)
    return feeds.template_projection(feeds.scan_ndjson(spark, path, FEED))


@query(
    "feed_explode",
    sql_with(
        "SELECT event_id, CAST(0 AS BIGINT) AS pos, CAST(CAST(ts AS DATE) AS VARCHAR)"
        " AS when_captured, CAST(user_id AS VARCHAR) AS device_urn, event_type AS device"
        " FROM events UNION ALL SELECT event_id, 1, CAST(CAST(ts AS DATE) AS VARCHAR),"
        " CAST(user_id AS VARCHAR), NULL FROM events",
        "m",
    ),
)
def feed_explode(spark, sf):
    """Two-object feed documents, one per event, to rows in their order."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    first = F.struct(
        F.to_date("ts").cast("string").alias("when_captured"),
        F.col("user_id").cast("string").alias("device_urn"),
        F.col("event_type").alias("device"),
    )
    second = F.struct(
        F.to_date("ts").cast("string").alias("when_captured"),
        F.col("user_id").cast("string").alias("device_urn"),
        F.lit(None).cast("string").alias("device"),
    )
    document = F.to_json(F.array(first, second))
    documents = events.select("event_id", document.alias("body"))
    schema = T.StructType([FEED[name] for name in ("when_captured", "device_urn", "device")])
    exploded = feeds.explode_feed(documents, "body", schema, "event_id")
    return exploded.withColumn("pos", F.col("pos").cast("bigint"))


@query("scan_parquet", "SELECT * FROM events")
def scan_parquet(spark, sf):
    return tables.scan_parquet(spark, f"{sf}/events.parquet")


@query("scan_parquet_columns", "SELECT ts, value FROM events")
def scan_parquet_columns(spark, sf):
    return tables.scan_parquet(spark, f"{sf}/events.parquet", "ts", "value")


@query("scan_full", sql_with("SELECT * FROM m", "m"))
def scan_full(spark, sf):
    measurements(spark, sf).createOrReplaceTempView("sensorspan_measurements")
    return tables.scan_full(spark, "sensorspan_measurements")


@query("scan_two_catalogs", sql_with("SELECT * FROM m", "m"))
def scan_two_catalogs(spark, sf):
    source, dest = scratch_path(spark, "source"), scratch_path(spark, "dest")
    measurements(spark, sf).write.parquet(f"{source}/measurements")
    tables.copy_tables(spark, source, dest, ["measurements"])
    return spark.read.schema(MEASUREMENTS).parquet(f"{dest}/measurements")


@query(
    "table_catalog",
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
def table_catalog(spark, sf):
    """Counts of the four tables, taken from the session's catalog of views."""
    views = {
        "measurements": measurements(spark, sf),
        "hourly_summary": hourly(spark, sf),
        "recent_data": recent(spark, sf),
        "daily_summary": daily(spark, sf),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    listed = {t.name for t in spark.catalog.listTables()}
    return row_counts({name: spark.table(name) for name in views if name in listed})


@query("ensure_tables", sql_with("SELECT * FROM d", "d"))
def ensure_tables(spark, sf):
    """The first call builds the rollup table, the second finds it there."""
    name = f"daily_summary_{uuid.uuid4().hex}"
    refreshed = []
    for _ in range(2):
        tables.ensure_tables(
            spark, {name: lambda: daily(spark, sf)}, lambda: refreshed.append(name)
        )
    if refreshed != [name]:
        raise RuntimeError("the second call had to refresh")
    return spark.table(name)


POINTS = (
    "SELECT CAST(user_id AS VARCHAR) AS device, CAST(user_id % 90 AS VARCHAR) AS loc_lat,"
    " CAST(user_id % 180 AS VARCHAR) AS loc_lon, CAST(value AS VARCHAR) AS reading FROM events"
)


@query(
    "normalise_legacy_feed",
    sql_with(
        "SELECT TRY_CAST(device AS BIGINT) AS device, TRY_CAST(loc_lat AS DOUBLE) AS loc_lat,"
        " TRY_CAST(loc_lon AS DOUBLE) AS loc_lon,"
        " TRY_CAST(TRY_CAST(reading AS DOUBLE) AS BIGINT) AS lnd_7318u, '0' AS device_urn,"
        " TIMESTAMP '2024-01-31' AS when_captured FROM p"
        " UNION ALL SELECT device, loc_lat, loc_lon, lnd_7318u, device_urn, when_captured FROM m",
        "m",
        p=POINTS,
    ),
)
def normalise_legacy_feed(spark, sf):
    """Events once as old point rows, once as old wide rows, both as facts."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    points_path = scratch_path(spark, "legacy-points")
    wide_path = scratch_path(spark, "legacy-wide")
    write_ndjson(
        events.select(
            (F.col("user_id") % 180).cast("string").alias("longitude"),
            (F.col("user_id") % 90).cast("string").alias("latitude"),
            F.col("user_id").cast("string").alias("device_id"),
            F.col("value").cast("string").alias("value"),
            F.lit("cpm").alias("unit"),
            F.lit("111").alias("height"),
        ),
        points_path,
    )
    facts = measurements(spark, sf)
    texts = [F.col(name).cast("string").alias(name) for name in FEED_FIELDS]
    write_ndjson(facts.select(*texts, F.lit("indoor").alias("device_class")), wide_path)
    feed = feeds.normalise_legacy(
        feeds.scan_ndjson(spark, points_path, LEGACY_POINT),
        feeds.scan_ndjson(spark, wide_path, LEGACY_WIDE),
    )
    typed = enforce_schema(clean_feed(feed, datetime(2024, 1, 31)))
    return typed.select("device", "loc_lat", "loc_lon", "lnd_7318u", "device_urn", TIME)

