"""Dedupe, merges and newest rows."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from ..config import scratch_path
from ..functions.timebuckets import moment
from ..operators import dedupe
from ..operators.filters import TIME
from ..operators.latest import latest_by_device, map_latest_positions
from ..operators.tables import last_sync, next_sync
from ..plans.views import register_views, run_sql, standing_views
from ..schema import MEASUREMENT_COLUMNS
from ..tables.bucketed import BucketedFacts
from .core import (
    AS_OF,
    EARLY,
    FEED_FROM,
    HELD_UNTIL,
    hourly,
    measurements,
    query,
    raw_feed,
    sql_with,
    ts,
)

DAY_AGO = AS_OF - timedelta(hours=24)
HELD = f"SELECT * FROM m WHERE when_captured < {ts(HELD_UNTIL)}"
# The next feed overlaps the held rows; its readings carry another voltage.
BATCH = f"SELECT * REPLACE ('4.2' AS bat_voltage) FROM m WHERE when_captured >= {ts(FEED_FROM)}"


def held_and_batch(spark, sf):
    facts = measurements(spark, sf)
    held = facts.filter(F.col(TIME) < moment(HELD_UNTIL))
    batch = facts.filter(F.col(TIME) >= moment(FEED_FROM)).withColumn("bat_voltage", F.lit("4.2"))
    return held, batch


@query(
    "latest_by_device",
    sql_with(
        "SELECT DISTINCT ON (device_urn) device_urn, device_sn, loc_country, loc_name, loc_lat,"
        " loc_lon, lnd_7318u AS radiation, when_captured AS last_reading FROM m"
        " ORDER BY device_urn, when_captured DESC",
        "m",
    ),
)
def latest_by_device_query(spark, sf):
    return latest_by_device(measurements(spark, sf))


@query(
    "map_latest_positions",
    sql_with(
        "SELECT DISTINCT ON (device_urn) device_urn, loc_lat AS latitude, loc_lon AS longitude,"
        f" avg_radiation AS value, hour AS time, loc_country FROM h WHERE hour >= {ts(DAY_AGO)}"
        " ORDER BY device_urn, hour DESC, loc_lat DESC, loc_lon DESC",
        "h",
    ),
)
def map_latest_positions_query(spark, sf):
    return map_latest_positions(hourly(spark, sf, DAY_AGO), DAY_AGO)


@query(
    "unique_by_first",
    sql_with(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER"
        " (PARTITION BY device_urn, when_captured ORDER BY pos) AS rn FROM f) WHERE rn = 1",
        "f",
    ),
)
def unique_by_first(spark, sf):
    return dedupe.unique_by_first(raw_feed(spark, sf))


@query(
    "select_distinct",
    sql_with("SELECT DISTINCT * FROM (SELECT * FROM m UNION ALL SELECT * FROM m)", "m"),
)
def select_distinct(spark, sf):
    facts = measurements(spark, sf)
    return dedupe.distinct_rows(facts.unionByName(facts))


@query(
    "periodic_dedupe",
    sql_with(f"SELECT DISTINCT * FROM ({HELD} UNION ALL SELECT * FROM m)", "m"),
)
def periodic_dedupe(spark, sf):
    """Readings before HELD_UNTIL are stored twice; the rewrite leaves one of each."""
    facts = measurements(spark, sf)
    doubled = facts.unionByName(facts.filter(F.col(TIME) < moment(HELD_UNTIL)))
    return dedupe.distinct_rows(doubled)


@query(
    "join_anti_dedupe",
    sql_with(
        "SELECT n.* FROM n LEFT JOIN held ON n.device = held.device"
        " AND n.when_captured = held.when_captured WHERE held.device IS NULL",
        "m",
        held=HELD,
        n=BATCH,
    ),
)
def join_anti_dedupe(spark, sf):
    held, batch = held_and_batch(spark, sf)
    return dedupe.unmatched(batch, held)


@query(
    "join_anti_bounded",
    sql_with(
        "SELECT n.* FROM n LEFT JOIN held ON n.device = held.device"
        " AND n.when_captured = held.when_captured"
        f" AND held.when_captured >= CAST({ts(EARLY)} AS DATE) - INTERVAL 7 DAY"
        " WHERE held.device IS NULL",
        "m",
        held=HELD,
        n=BATCH,
    ),
)
def join_anti_bounded(spark, sf):
    held, batch = held_and_batch(spark, sf)
    return dedupe.unmatched_recent(batch, held, EARLY, days=7)


TWICE = (
    "SELECT *, 0 AS pos FROM n UNION ALL SELECT * REPLACE ('9.9' AS bat_voltage), 1 AS pos FROM n"
)


@query(
    "insert_or_ignore",
    sql_with(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER"
        " (PARTITION BY device, when_captured ORDER BY pos) AS rn FROM twice) t WHERE rn = 1"
        " AND NOT EXISTS (SELECT 1 FROM held WHERE held.device = t.device"
        " AND held.when_captured = t.when_captured)",
        "m",
        held=HELD,
        n=BATCH,
        twice=TWICE,
    ),
)
def insert_or_ignore(spark, sf):
    """A batch that repeats itself and overlaps the table."""
    held, batch = held_and_batch(spark, sf)
    again = batch.withColumn("bat_voltage", F.lit("9.9"))
    twice = batch.withColumn("pos", F.lit(0)).unionByName(again.withColumn("pos", F.lit(1)))
    return dedupe.insert_or_ignore(twice, held, ["pos"])


def _bucketed(spark, rows) -> BucketedFacts:
    name = f"facts_{uuid.uuid4().hex}"
    table = BucketedFacts(spark, name, scratch_path(spark, name), buckets=8)
    table.append(rows)
    return table


@query(
    "join_anti_bucketed",
    sql_with(
        "SELECT n.* FROM n LEFT JOIN held ON n.device = held.device"
        " AND n.when_captured = held.when_captured WHERE held.device IS NULL",
        "m",
        held=HELD,
        n=BATCH,
    ),
)
def join_anti_bucketed(spark, sf):
    """The unseen rows of a batch, against facts that are read where they lie."""
    held, batch = held_and_batch(spark, sf)
    return _bucketed(spark, held).unmatched(batch)


@query(
    "insert_or_ignore_bucketed",
    sql_with(
        f"SELECT * FROM held UNION ALL SELECT * FROM n WHERE when_captured >= {ts(HELD_UNTIL)}",
        "m",
        held=HELD,
        n=BATCH,
    ),
)
def insert_or_ignore_bucketed(spark, sf):
    """The table of facts after a batch that repeats itself and overlaps it."""
    held, batch = held_and_batch(spark, sf)
    again = batch.withColumn("bat_voltage", F.lit("9.9"))
    twice = batch.withColumn("pos", F.lit(0)).unionByName(again.withColumn("pos", F.lit(1)))
    table = _bucketed(spark, held.withColumn("pos", F.lit(0)))
    table.insert_or_ignore(twice, ["pos"])
    return table.facts().select(*MEASUREMENT_COLUMNS)


@query(
    "sink_append_new",
    sql_with(
        f"SELECT * FROM held UNION ALL SELECT * FROM n WHERE when_captured >= {ts(HELD_UNTIL)}",
        "m",
        held=HELD,
        n=BATCH,
    ),
)
def sink_append_new(spark, sf):
    """The table after the unseen rows of the batch were appended."""
    held, batch = held_and_batch(spark, sf)
    path = scratch_path(spark, "append-new")
    held.write.parquet(path)
    stored = spark.read.schema(held.schema).parquet(path)
    dedupe.unmatched(batch, stored).write.mode("append").parquet(path)
    return spark.read.schema(held.schema).parquet(path)


@query(
    "sink_upsert",
    sql_with(
        f"SELECT * FROM n UNION ALL SELECT * FROM held WHERE when_captured < {ts(FEED_FROM)}",
        "m",
        held=HELD,
        n=BATCH,
    ),
)
def sink_upsert(spark, sf):
    held, batch = held_and_batch(spark, sf)
    return dedupe.upsert(held, batch, ["device", TIME])


@query(
    "merge_history_first_wins",
    sql_with(
        "SELECT * EXCLUDE (rn, src) FROM (SELECT *, ROW_NUMBER() OVER"
        " (PARTITION BY device_urn, when_captured ORDER BY src, bat_voltage) AS rn FROM"
        " (SELECT *, 0 AS src FROM held UNION ALL SELECT *, 1 AS src FROM n)) WHERE rn = 1"
        " ORDER BY when_captured DESC",
        "m",
        held=HELD,
        n=BATCH,
    ),
)
def merge_history_first_wins(spark, sf):
    held, batch = held_and_batch(spark, sf)
    merged = dedupe.merge_history(held, batch, ["bat_voltage"])
    return merged.orderBy(F.desc(TIME), "device_urn")


@query(
    "sync_state",
    sql_with(
        "SELECT 'measurements' AS table_name,"
        " COALESCE((SELECT MAX(when_captured) FROM held), TIMESTAMP '1970-01-01') AS old_sync,"
        f" (SELECT MAX(when_captured) FROM m WHERE when_captured <= {ts(EARLY)}) AS new_sync,"
        " TIMESTAMP '1970-01-01' AS never_synced",
        "m",
        held=HELD,
    ),
)
def sync_state(spark, sf):
    """Stored and next watermark; rows after ``EARLY`` count as future and do not move it."""
    facts = measurements(spark, sf, TIME)
    state = next_sync(facts.filter(F.col(TIME) < moment(HELD_UNTIL)), AS_OF)
    return next_sync(facts, EARLY).select(
        "table_name",
        last_sync(state, "measurements").scalar().alias("old_sync"),
        F.col("last_sync_timestamp").alias("new_sync"),
        last_sync(state, "hourly_summary").scalar().alias("never_synced"),
    )


@query(
    "sql_on_views",
    sql_with(
        "SELECT l.device_urn, l.radiation, l.last_reading, s.hour, s.avg_radiation"
        " FROM (SELECT DISTINCT ON (device_urn) device_urn, lnd_7318u AS radiation,"
        " when_captured AS last_reading FROM m ORDER BY device_urn, when_captured DESC) l"
        " JOIN h s ON s.device_urn = l.device_urn AND s.hour = date_trunc('hour', l.last_reading)"
        f" WHERE s.hour >= {ts(DAY_AGO)}",
        "h",
    ),
)
def sql_on_views(spark, sf):
    """A query in SQL over two of the standing views, with a parameter."""
    register_views(standing_views(measurements(spark, sf), AS_OF), "standing_")
    return run_sql(
        spark,
        "SELECT l.device_urn, l.radiation, l.last_reading, s.hour, s.avg_radiation"
        " FROM standing_latest_by_device l JOIN standing_hourly_stats s"
        " ON s.device_urn = l.device_urn"
        " AND s.hour = CAST(date_trunc('HOUR', l.last_reading) AS TIMESTAMP_NTZ)"
        " WHERE s.hour >= CAST(:since AS TIMESTAMP_NTZ)",
        since=DAY_AGO.isoformat(sep=" "),
    )
