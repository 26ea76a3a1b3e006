"""Rollups and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timebuckets import moment
from ..operators import rollups
from ..operators.dedupe import unmatched
from ..operators.filters import TIME
from ..operators.tables import batch_report, footer_sum, last_sync
from ..plans import panels
from ..plans.ingest import valid_time
from .core import (
    AS_OF,
    DEVICES,
    FEED_FROM,
    FROM,
    HELD_UNTIL,
    TO,
    daily,
    hourly,
    measurements,
    query,
    recent,
    rounded,
    sql_rounded,
    sql_with,
    ts,
)

KEYS = "device_urn, device_sn, loc_country, loc_name, loc_lat, loc_lon"
RANGE = f"when_captured >= {ts(FROM)} AND when_captured <= {ts(TO)}"
DEVICE_LIST = ", ".join(f"'{d}'" for d in DEVICES)


@query("hourly_summary", sql_with("SELECT * FROM h", "h"))
def hourly_summary(spark, sf):
    return hourly(spark, sf)


@query("daily_summary", sql_with("SELECT * FROM d", "d"))
def daily_summary(spark, sf):
    return daily(spark, sf)


@query("recent_data", sql_with("SELECT * FROM r", "r"))
def recent_data(spark, sf):
    return recent(spark, sf)


def _stats_sql(unit: str, days: int) -> str:
    return sql_with(
        f"SELECT date_trunc('{unit}', when_captured)::TIMESTAMP AS {unit}, device_urn, loc_country,"
        " COUNT(*) AS reading_count, AVG(TRY_CAST(lnd_7318u AS DOUBLE)) AS avg_radiation,"
        " MAX(TRY_CAST(lnd_7318u AS DOUBLE)) AS max_radiation,"
        " MIN(TRY_CAST(lnd_7318u AS DOUBLE)) AS min_radiation"
        f" FROM m WHERE when_captured >= {ts(AS_OF)} - INTERVAL {days} DAY"
        f" GROUP BY 1, 2, 3 ORDER BY {unit} DESC",
        "m",
    )


STATS_COLUMNS = ("device_urn", "loc_country", "lnd_7318u", TIME)


@query("hourly_stats", _stats_sql("hour", 30))
def hourly_stats(spark, sf):
    stats = rollups.hourly_stats(measurements(spark, sf, *STATS_COLUMNS), AS_OF)
    return stats.orderBy(F.desc("hour"), "device_urn", "loc_country")


@query("daily_stats", _stats_sql("day", 90))
def daily_stats(spark, sf):
    stats = rollups.daily_stats(measurements(spark, sf, *STATS_COLUMNS), AS_OF)
    return stats.orderBy(F.desc("day"), "device_urn", "loc_country")


@query(
    "daily_stats_min",
    sql_with(
        "SELECT CAST(when_captured AS DATE) AS day, device_urn, COUNT(*) AS readings,"
        " AVG(lnd_7318u) AS avg_radiation FROM m GROUP BY 1, 2",
        "m",
    ),
)
def daily_stats_min(spark, sf):
    return panels.daily_stats_min(measurements(spark, sf, "device_urn", "lnd_7318u", TIME))


def _held_and_new(spark, sf):
    """Facts before the load, and the facts the load adds: readings of the
    feed's range, plus readings long before it that arrive late."""
    facts = measurements(spark, sf)
    late = F.col("lnd_7128ec") != "0"
    held = facts.filter((F.col(TIME) < moment(FEED_FROM)) & ~late)
    new = facts.filter((F.col(TIME) >= moment(FEED_FROM)) | late)
    return facts, held, new


@query("hourly_summary_incremental", sql_with("SELECT * FROM h", "h"))
def hourly_summary_incremental(spark, sf):
    facts, held, new = _held_and_new(spark, sf)
    before = rollups.hourly_summary(held, AS_OF)
    return rollups.hourly_incremental(before, facts, new, AS_OF)


@query("daily_summary_incremental", sql_with("SELECT * FROM d", "d"))
def daily_summary_incremental(spark, sf):
    facts, held, new = _held_and_new(spark, sf)
    return rollups.daily_incremental(rollups.daily_summary(held), facts, new)


@query("daily_from_hourly", sql_with("SELECT * FROM d", "d"))
def daily_from_hourly(spark, sf):
    state = rollups.bucket_state(measurements(spark, sf), rollups.hour_of(TIME), "hour")
    return rollups.summary(rollups.daily_from_hourly(state), "day")


@query("count_all", sql_with("SELECT COUNT(*) AS total FROM m", "m"))
def count_all(spark, sf):
    return panels.count_all(measurements(spark, sf, TIME))


@query(
    "basic_stats",
    sql_with(
        "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT device_urn) AS unique_devices,"
        " MIN(when_captured) AS earliest, MAX(when_captured) AS latest FROM m",
        "m",
    ),
)
def basic_stats(spark, sf):
    return panels.basic_stats(measurements(spark, sf, "device_urn", TIME))


@query(
    "freshness",
    sql_with("SELECT MAX(when_captured) AS latest, COUNT(*) AS total FROM m", "m"),
)
def freshness(spark, sf):
    return panels.freshness(measurements(spark, sf, TIME))


@query(
    "count_range_sane",
    sql_with(
        "SELECT COUNT(*) AS total, MIN(when_captured) AS earliest, MAX(when_captured) AS latest"
        " FROM m WHERE when_captured < TIMESTAMP '2030-01-01'",
        "m",
    ),
)
def count_range_sane(spark, sf):
    return panels.count_range_sane(measurements(spark, sf, TIME))


@query(
    "recent_device_activity",
    sql_with(
        "SELECT device_urn, COUNT(*) AS measurement_count, MAX(when_captured) AS last_seen"
        " FROM m GROUP BY device_urn ORDER BY last_seen DESC, device_urn LIMIT 10",
        "m",
    ),
)
def recent_device_activity(spark, sf):
    return panels.recent_device_activity(measurements(spark, sf, "device_urn", TIME))


def _device_agg_sql(limit: int) -> str:
    return sql_with(
        "SELECT device_urn, COUNT(*) AS reading_count,"
        " AVG(TRY_CAST(lnd_7318u AS DOUBLE)) AS avg_radiation,"
        " MAX(TRY_CAST(lnd_7318u AS DOUBLE)) AS max_radiation,"
        " MIN(when_captured) AS first_reading, MAX(when_captured) AS last_reading"
        f" FROM m WHERE when_captured >= {ts(AS_OF)} - INTERVAL 24 HOUR GROUP BY device_urn"
        f" ORDER BY reading_count DESC, device_urn LIMIT {limit}",
        "m",
    )


@query("device_agg_24h", _device_agg_sql(20))
def device_agg_24h(spark, sf):
    return panels.device_agg_24h(measurements(spark, sf, "device_urn", "lnd_7318u", TIME), AS_OF)


@query("device_agg_24h_wide", _device_agg_sql(100))
def device_agg_24h_wide(spark, sf):
    facts = measurements(spark, sf, "device_urn", "lnd_7318u", TIME)
    return panels.device_agg_24h(facts, AS_OF, limit=100)


@query(
    "daily_activity_7d",
    sql_with(
        "SELECT date_trunc('day', when_captured)::TIMESTAMP AS day, COUNT(*) AS readings_per_day,"
        " COUNT(DISTINCT device_urn) AS active_devices FROM m"
        f" WHERE when_captured >= {ts(AS_OF)} - INTERVAL 7 DAY GROUP BY 1 ORDER BY 1 DESC",
        "m",
    ),
)
def daily_activity_7d(spark, sf):
    return panels.daily_activity_7d(measurements(spark, sf, "device_urn", TIME), AS_OF)


@query(
    "country_agg",
    sql_with(
        "SELECT loc_country, COUNT(*) AS reading_count, COUNT(DISTINCT device_urn) AS devices,"
        " AVG(TRY_CAST(lnd_7318u AS DOUBLE)) AS avg_radiation FROM m"
        " WHERE loc_country IS NOT NULL GROUP BY loc_country"
        " ORDER BY reading_count DESC, loc_country LIMIT 10",
        "m",
    ),
)
def country_agg(spark, sf):
    return panels.country_agg(measurements(spark, sf, "loc_country", "device_urn", "lnd_7318u"))


@query(
    "count_between",
    sql_with(
        "SELECT COUNT(*) AS total FROM m WHERE when_captured"
        f" BETWEEN {ts(FROM)} AND {ts(TO)}",
        "m",
    ),
)
def count_between(spark, sf):
    return panels.count_between(measurements(spark, sf, TIME), FROM, TO)


@query(
    "country_counts",
    sql_with("SELECT loc_country, COUNT(*) AS reading_count FROM m GROUP BY loc_country", "m"),
)
def country_counts(spark, sf):
    return panels.country_counts(measurements(spark, sf, "loc_country"))


@query(
    "country_daily",
    sql_with(
        "SELECT date_trunc('day', when_captured)::TIMESTAMP AS day, loc_country,"
        f" AVG(lnd_7318u) AS avg_radiation FROM m WHERE when_captured >= {ts(AS_OF)}"
        " - INTERVAL 30 DAY GROUP BY 1, 2",
        "m",
    ),
)
def country_daily(spark, sf):
    return panels.country_daily(measurements(spark, sf, "loc_country", "lnd_7318u", TIME), AS_OF)


@query(
    "devices_avg_7d",
    sql_with(
        f"SELECT device_urn, AVG(lnd_7318u) AS avg_radiation FROM m WHERE device_urn IN"
        f" ({DEVICE_LIST}) AND when_captured >= {ts(AS_OF)} - INTERVAL 7 DAY GROUP BY device_urn",
        "m",
    ),
)
def devices_avg_7d(spark, sf):
    facts = measurements(spark, sf, "device_urn", "lnd_7318u", TIME)
    return panels.devices_avg_7d(facts, AS_OF, DEVICES)


@query("device_count", sql_with("SELECT COUNT(DISTINCT device_urn) AS device_count FROM m", "m"))
def device_count(spark, sf):
    return panels.device_count(measurements(spark, sf, "device_urn"))


@query(
    "hourly_active_devices",
    sql_with(
        "SELECT date_trunc('hour', when_captured) AS time, COUNT(DISTINCT device_urn)"
        f" AS active_devices FROM m WHERE {RANGE} GROUP BY 1 ORDER BY 1",
        "m",
    ),
)
def hourly_active_devices(spark, sf):
    return panels.hourly_active_devices(measurements(spark, sf, "device_urn", TIME), FROM, TO)


@query(
    "top_radiation",
    sql_with(
        "SELECT device_urn, AVG(lnd_7318u) AS avg_radiation, COUNT(*) AS reading_count FROM m"
        f" WHERE lnd_7318u > 0 AND {RANGE} GROUP BY device_urn"
        " ORDER BY avg_radiation DESC, device_urn LIMIT 10",
        "m",
    ),
)
def top_radiation(spark, sf):
    return panels.top_radiation(measurements(spark, sf, "device_urn", "lnd_7318u", TIME), FROM, TO)


@query(
    "pm25_by_location",
    sql_rounded(
        sql_with(
            "SELECT loc_country, loc_lat, loc_lon, AVG(TRY_CAST(pms_pm02_5 AS DOUBLE)) AS avg_pm25"
            f" FROM m WHERE pms_pm02_5 != '0' AND {RANGE} GROUP BY 1, 2, 3",
            "m",
        ),
        "avg_pm25",
    ),
)
def pm25_by_location(spark, sf):
    facts = measurements(spark, sf, "loc_country", "loc_lat", "loc_lon", "pms_pm02_5", TIME)
    return rounded(panels.pm25_by_location(facts, FROM, TO), "avg_pm25")


@query(
    "device_activity_map",
    sql_with(
        "SELECT device_urn, loc_lat AS latitude, loc_lon AS longitude, loc_country,"
        " COUNT(*) AS measurement_count, MAX(when_captured) AS last_seen,"
        f" AVG(lnd_7318u) AS avg_radiation FROM m WHERE loc_lat != 0 AND loc_lon != 0 AND {RANGE}"
        " GROUP BY 1, 2, 3, 4",
        "m",
    ),
)
def device_activity_map(spark, sf):
    facts = measurements(
        spark, sf, "device_urn", "loc_lat", "loc_lon", "loc_country", "lnd_7318u", TIME
    )
    return panels.device_activity_map(facts, FROM, TO)


@query(
    "hourly_radiation_by_device",
    sql_with(
        "SELECT date_trunc('hour', when_captured) AS time, device_urn, AVG(lnd_7318u) AS radiation"
        f" FROM m WHERE lnd_7318u > 0 AND {RANGE} GROUP BY 1, 2 ORDER BY 1, 2",
        "m",
    ),
)
def hourly_radiation_by_device(spark, sf):
    facts = measurements(spark, sf, "device_urn", "lnd_7318u", TIME)
    return panels.hourly_radiation_by_device(facts, FROM, TO)


DEVICE_STATS_SQL = (
    "SELECT device_urn, AVG(lnd_7318u) AS avg_radiation, STDDEV(lnd_7318u) AS stddev_radiation"
    " FROM m WHERE lnd_7318u > 0 GROUP BY device_urn"
)


@query(
    "anomalies_zscore",
    sql_rounded(
        sql_with(
            "SELECT m.when_captured, m.device_urn, m.lnd_7318u, s.avg_radiation,"
            " (m.lnd_7318u - s.avg_radiation) / NULLIF(s.stddev_radiation, 0) AS z_score"
            " FROM m JOIN s ON m.device_urn = s.device_urn"
            " WHERE (m.lnd_7318u - s.avg_radiation) / NULLIF(s.stddev_radiation, 0) > 2"
            f" AND {RANGE} ORDER BY m.when_captured DESC",
            "m",
            s=DEVICE_STATS_SQL,
        ),
        "avg_radiation",
        "z_score",
    ),
)
def anomalies_zscore(spark, sf):
    facts = measurements(spark, sf, "device_urn", "lnd_7318u", TIME)
    return rounded(panels.anomalies_zscore(facts, FROM, TO), "avg_radiation", "z_score")


@query(
    "device_uptime",
    sql_with(
        "SELECT device_urn, MIN(when_captured) AS first_seen, MAX(when_captured) AS last_seen,"
        " COUNT(*) AS total_readings, (epoch_us(MAX(when_captured)) -"
        f" epoch_us(MIN(when_captured))) / 1e6 / 86400 AS days_active FROM m WHERE {RANGE}"
        " GROUP BY device_urn ORDER BY days_active DESC",
        "m",
    ),
)
def device_uptime(spark, sf):
    return panels.device_uptime(measurements(spark, sf, "device_urn", TIME), FROM, TO)


@query(
    "hourly_freshness",
    sql_with(
        "SELECT date_trunc('hour', when_captured) AS time, COUNT(*) AS readings_received FROM m"
        f" WHERE when_captured >= {ts(AS_OF)} - INTERVAL 24 HOUR GROUP BY 1 ORDER BY 1",
        "m",
    ),
)
def hourly_freshness(spark, sf):
    return panels.hourly_freshness(measurements(spark, sf, TIME), AS_OF)


@query(
    "table_footer_sum",
    sql_with(
        "SELECT CAST(SUM(dev_temp) AS DOUBLE) AS dev_temp, CAST(SUM(device) AS DOUBLE) AS device,"
        " CAST(SUM(env_temp) AS DOUBLE) AS env_temp, CAST(SUM(lnd_7318u) AS DOUBLE) AS lnd_7318u,"
        " SUM(loc_lat) AS loc_lat, SUM(loc_lon) AS loc_lon FROM m",
        "m",
    ),
)
def table_footer_sum(spark, sf):
    return footer_sum(measurements(spark, sf))


@query(
    "batch_report",
    sql_with(
        "SELECT (SELECT COUNT(*) FROM m WHERE when_captured >= {feed}) AS fetched,"
        " (SELECT COUNT(*) FROM m WHERE when_captured >= {feed}) AS valid,"
        " (SELECT COUNT(*) FROM m WHERE when_captured >= {held}) AS new,"
        " (SELECT COUNT(*) FROM m) AS total,"
        " (SELECT MAX(when_captured) FROM m WHERE when_captured < {held}) AS old_watermark,"
        " (SELECT MAX(when_captured) FROM m) AS new_watermark".format(
            feed=ts(FEED_FROM), held=ts(HELD_UNTIL)
        ),
        "m",
    ),
)
def batch_report_query(spark, sf):
    facts = measurements(spark, sf, "device", TIME)
    held = facts.filter(F.col(TIME) < moment(HELD_UNTIL))
    fetched = facts.filter(F.col(TIME) >= moment(FEED_FROM))
    state = held.agg(
        F.lit("measurements").alias("table_name"), F.max(TIME).alias("last_sync_timestamp")
    )
    new = unmatched(fetched, held)
    return batch_report(
        fetched, valid_time(fetched), new, held.unionByName(new), last_sync(state, "measurements")
    )
