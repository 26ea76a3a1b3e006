"""Dashboard panels over the rollups and the raw tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..operators.filters import TIME
from ..operators.rollups import daily_summary, hourly_summary, recent_data
from ..operators.tables import table_span, union_all
from ..plans import panels
from .core import (
    AS_OF,
    DEVICES,
    FROM,
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

DAY_AGO = AS_OF - timedelta(hours=24)
WEEK_AGO = AS_OF - timedelta(days=7)
WEEK_FROM = datetime(2024, 1, 25, 3, 30)
WEEK_TO = datetime(2024, 1, 29, 21)
YEAR_FROM = datetime(2024, 1, 2)
YEAR_TO = datetime(2024, 1, 28)
DEVICE_LIST = ", ".join(f"'{d}'" for d in DEVICES)


def _range(column: str, frm: datetime, to: datetime) -> str:
    return f"{column} >= {ts(frm)} AND {column} <= {ts(to)}"


@query(
    "radiation_over_time",
    sql_with(
        "SELECT hour AS time, device_urn AS metric, avg_radiation AS value FROM h"
        f" WHERE {_range('hour', FROM, TO)} AND device_urn IN ({DEVICE_LIST}) ORDER BY hour",
        "h",
    ),
)
def radiation_over_time(spark, sf):
    return panels.radiation_over_time(hourly(spark, sf, FROM, TO), FROM, TO, DEVICES)


@query(
    "all_devices_24h",
    sql_with(
        "SELECT hour AS time, device_urn, avg_radiation, reading_count, loc_country FROM h"
        f" WHERE hour >= {ts(DAY_AGO)}"
        " ORDER BY hour DESC, device_urn, loc_country, reading_count, avg_radiation LIMIT 1000",
        "h",
    ),
)
def all_devices_24h(spark, sf):
    return panels.all_devices_24h(hourly(spark, sf, DAY_AGO), AS_OF)


@query(
    "device_list_latest",
    sql_rounded(
        sql_with(
            "SELECT device_urn, MAX(hour) AS last_seen, AVG(avg_radiation) AS avg_radiation,"
            " CAST(SUM(reading_count) AS BIGINT) AS total_readings,"
            " MIN_BY(loc_country, hour) AS country"
            f" FROM h WHERE hour >= {ts(WEEK_AGO)} GROUP BY device_urn ORDER BY last_seen DESC",
            "h",
        ),
        "avg_radiation",
    ),
)
def device_list_latest(spark, sf):
    return rounded(panels.device_list_latest(hourly(spark, sf, WEEK_AGO), AS_OF), "avg_radiation")


@query(
    "geo_distribution",
    sql_rounded(
        sql_with(
            "SELECT loc_country AS country, COUNT(DISTINCT device_urn) AS device_count,"
            " AVG(avg_radiation) AS avg_radiation,"
            " CAST(SUM(reading_count) AS BIGINT) AS total_readings"
            f" FROM h WHERE hour >= {ts(WEEK_AGO)} GROUP BY loc_country ORDER BY device_count DESC",
            "h",
        ),
        "avg_radiation",
    ),
)
def geo_distribution(spark, sf):
    return rounded(panels.geo_distribution(hourly(spark, sf, WEEK_AGO), AS_OF), "avg_radiation")


@query(
    "stats_panel",
    sql_rounded(
        sql_with(
            "SELECT COUNT(DISTINCT device_urn) AS active_devices,"
            " AVG(avg_radiation) AS avg_radiation, MAX(max_radiation) AS max_radiation,"
            " CAST(SUM(reading_count) AS BIGINT) AS total_readings"
            f" FROM h WHERE hour >= {ts(DAY_AGO)}",
            "h",
        ),
        "avg_radiation",
    ),
)
def stats_panel(spark, sf):
    return rounded(panels.stats_panel(hourly(spark, sf, DAY_AGO), AS_OF), "avg_radiation")


@query(
    "summary_series_24h",
    sql_with(
        "SELECT hour AS time, device_sn, avg_radiation, avg_temp FROM h"
        f" WHERE hour >= {ts(DAY_AGO)} ORDER BY hour",
        "h",
    ),
)
def summary_series_24h(spark, sf):
    return panels.summary_series_24h(hourly(spark, sf, DAY_AGO), AS_OF)


@query(
    "summary_metric_24h",
    sql_with(
        "SELECT hour AS time, device_urn AS metric, avg_radiation AS value FROM h"
        f" WHERE hour >= {ts(DAY_AGO)} ORDER BY hour",
        "h",
    ),
)
def summary_metric_24h(spark, sf):
    return panels.summary_metric_24h(hourly(spark, sf, DAY_AGO), AS_OF)


@query("summary_all_24h", sql_with(f"SELECT * FROM h WHERE hour >= {ts(DAY_AGO)}", "h"))
def summary_all_24h(spark, sf):
    return panels.summary_all_24h(hourly(spark, sf, DAY_AGO), AS_OF)


@query(
    "summary_newest_10",
    sql_with(
        f"SELECT * FROM h WHERE hour >= {ts(DAY_AGO)} ORDER BY hour DESC, device_urn, device_sn,"
        " loc_country, loc_name, loc_lat, loc_lon LIMIT 10",
        "h",
    ),
)
def summary_newest_10(spark, sf):
    return panels.summary_all_24h(hourly(spark, sf, DAY_AGO), AS_OF, limit=10)


@query(
    "recent_series",
    sql_with(
        "SELECT when_captured AS time, device_urn, CAST(lnd_7318u AS DOUBLE) AS radiation FROM r"
        f" WHERE {_range('when_captured', WEEK_FROM, WEEK_TO)} AND device_urn IN ({DEVICE_LIST})"
        " ORDER BY time",
        "r",
    ),
)
def recent_series(spark, sf):
    rows = recent(spark, sf, TIME, "device_urn", "lnd_7318u")
    return panels.recent_series(rows, WEEK_FROM, WEEK_TO, DEVICES)


@query(
    "monthly_series",
    sql_with(
        "SELECT hour AS time, device_urn, avg_radiation AS radiation FROM h"
        f" WHERE {_range('hour', FROM, TO)} AND device_urn IN ({DEVICE_LIST}) ORDER BY time",
        "h",
    ),
)
def monthly_series(spark, sf):
    return panels.monthly_series(hourly(spark, sf, FROM, TO), FROM, TO, DEVICES)


@query(
    "yearly_series",
    sql_with(
        "SELECT CAST(day AS TIMESTAMP) AS time, device_urn, avg_radiation AS radiation FROM d"
        f" WHERE {_range('day', YEAR_FROM, YEAR_TO)} AND device_urn IN ({DEVICE_LIST})"
        " ORDER BY time",
        "d",
    ),
)
def yearly_series(spark, sf):
    return panels.yearly_series(
        daily(spark, sf, YEAR_FROM, YEAR_TO), YEAR_FROM, YEAR_TO, DEVICES
    )


@query(
    "tier_route",
    sql_with(
        "SELECT 'recent' AS tier, when_captured AS time, device_urn,"
        " CAST(lnd_7318u AS DOUBLE) AS radiation FROM r"
        f" WHERE {_range('when_captured', WEEK_FROM, WEEK_TO)} AND device_urn IN ({DEVICE_LIST})"
        " UNION ALL SELECT 'hourly', hour, device_urn, avg_radiation FROM h"
        f" WHERE {_range('hour', FROM, TO)} AND device_urn IN ({DEVICE_LIST})"
        " UNION ALL SELECT 'daily', CAST(day AS TIMESTAMP), device_urn, avg_radiation FROM d"
        f" WHERE {_range('day', datetime(2023, 12, 1), TO)} AND device_urn IN ({DEVICE_LIST})"
        " UNION ALL SELECT 'facts', when_captured, device_urn, CAST(lnd_7318u AS DOUBLE) FROM m"
        f" WHERE {_range('when_captured', datetime(2020, 1, 1), FROM)}"
        f" AND device_urn IN ({DEVICE_LIST})",
        "r",
        "h",
        "d",
    ),
)
def tier_route(spark, sf):
    """Four ranges of growing width, each answered from the table it is routed to."""
    tables = {
        "recent": recent(spark, sf, TIME, "device_urn", "lnd_7318u"),
        "hourly": hourly(spark, sf, FROM, TO),
        "daily": daily(spark, sf),
        "facts": measurements(spark, sf, TIME, "device_urn", "lnd_7318u"),
    }
    ranges = [
        (WEEK_FROM, WEEK_TO),
        (FROM, TO),
        (datetime(2023, 12, 1), TO),
        (datetime(2020, 1, 1), FROM),
    ]
    return union_all(
        *(
            panels.tier_route(tables, frm, to, DEVICES, AS_OF).select(
                F.lit(panels.tier_of(frm, AS_OF)).alias("tier"), "*"
            )
            for frm, to in ranges
        )
    )


@query(
    "recent_detail",
    sql_with(
        "SELECT when_captured AS time, device_urn AS metric,"
        " TRY_CAST(lnd_7318u AS DOUBLE) AS radiation, loc_lat, loc_lon, loc_country FROM r"
        f" WHERE {_range('when_captured', WEEK_FROM, WEEK_TO)}"
        " ORDER BY when_captured DESC, metric, radiation LIMIT 5000",
        "r",
    ),
)
def recent_detail(spark, sf):
    rows = recent(
        spark, sf, TIME, "device_urn", "lnd_7318u", "loc_lat", "loc_lon", "loc_country"
    )
    return panels.recent_detail(rows, WEEK_FROM, WEEK_TO)


@query(
    "recent_24h",
    sql_with(
        "SELECT when_captured AS time, device_urn, lnd_7318u AS radiation FROM r"
        f" WHERE when_captured >= {ts(DAY_AGO)} ORDER BY when_captured DESC",
        "r",
    ),
)
def recent_24h(spark, sf):
    return panels.recent_24h(recent(spark, sf, TIME, "device_urn", "lnd_7318u"), AS_OF)


def _fact_series_sql(frm: datetime, to: datetime, limit: int) -> str:
    return sql_with(
        "SELECT when_captured AS time, device_urn, TRY_CAST(lnd_7318u AS DOUBLE) AS radiation,"
        f" loc_country FROM m WHERE {_range('when_captured', frm, to)}"
        f" ORDER BY when_captured DESC, device_urn, radiation, loc_country LIMIT {limit}",
        "m",
    )


SERIES = (TIME, "device_urn", "lnd_7318u", "loc_country")


@query("fact_series_range", _fact_series_sql(FROM, TO, 10_000))
def fact_series_range(spark, sf):
    return panels.fact_series_range(measurements(spark, sf, *SERIES), FROM, TO)


@query("fact_series_24h", _fact_series_sql(DAY_AGO, AS_OF, 5000))
def fact_series_24h(spark, sf):
    return panels.fact_series_range(measurements(spark, sf, *SERIES), DAY_AGO, AS_OF, limit=5000)


def _fact_recent_sql(since: datetime, limit: int) -> str:
    return sql_with(
        f"SELECT * FROM m WHERE when_captured >= {ts(since)}"
        f" ORDER BY when_captured DESC, device LIMIT {limit}",
        "m",
    )


@query("fact_recent_limit", _fact_recent_sql(WEEK_AGO, 10_000))
def fact_recent_limit(spark, sf):
    return panels.fact_recent_limit(measurements(spark, sf), AS_OF)


@query("fact_recent_limit_24h", _fact_recent_sql(DAY_AGO, 1000))
def fact_recent_limit_24h(spark, sf):
    return panels.fact_recent_limit(measurements(spark, sf), AS_OF, limit=1000, hours=24)


def _span_sql(name: str, view: str, column: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count,"
        f" CAST(MIN({column}) AS TIMESTAMP) AS earliest,"
        f" CAST(MAX({column}) AS TIMESTAMP) AS latest FROM {view}"
    )


@query(
    "union_all_stats",
    sql_with(
        " UNION ALL ".join(
            (
                _span_sql("measurements", "m", "when_captured"),
                _span_sql("hourly_summary", "h", "hour"),
                _span_sql("recent_data", "r", "when_captured"),
                _span_sql("daily_summary", "d", "day"),
            )
        ),
        "m",
        "h",
        "r",
        "d",
    ),
)
def union_all_stats(spark, sf):
    facts = measurements(spark, sf)
    return union_all(
        table_span(facts, "measurements", TIME),
        table_span(hourly_summary(facts, AS_OF), "hourly_summary", "hour"),
        table_span(recent_data(facts, AS_OF), "recent_data", TIME),
        table_span(daily_summary(facts), "daily_summary", "day"),
    )
