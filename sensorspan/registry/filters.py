"""Filters, projections and scalar functions on the fact table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..config import materialise
from ..functions import classify, timebuckets
from ..functions.casting import to_double
from ..functions.cleaning import safe_name
from ..functions.stats import sync_message, z_score
from ..functions.timebuckets import moment
from ..operators import filters as flt
from ..operators.filters import TIME
from ..operators.joins import device_radiation_stats, join_device_stats
from ..operators.rollups import daily_summary
from ..operators.tables import (
    empty_clone,
    last_sync,
    organize,
    purge_future,
    retain,
    union_all,
)
from .aggregates import DEVICE_LIST, DEVICE_STATS_SQL, RANGE
from .core import (
    AS_OF,
    DEVICES,
    EARLY,
    FROM,
    HELD_UNTIL,
    TO,
    hourly,
    measurements,
    query,
    rounded,
    sql_rounded,
    sql_with,
    ts,
)

# The device tables' columns by place, and what each board hides.
TABLE_ORDER = {
    "when_captured": 0,
    "device_urn": 1,
    "device": 2,
    "device_sn": 3,
    "lnd_7128ec": 4,
    "lnd_7318c": 5,
    "lnd_7318u": 6,
    "pms_pm02_5": 7,
    "bat_voltage": 8,
    "dev_temp": 9,
    "env_temp": 10,
    "loc_country": 11,
    "loc_name": 12,
    "loc_lat": 13,
    "loc_lon": 14,
}
RADIATION_HIDDEN = {"dev_temp", "device", "device_sn", "env_temp", "loc_lat", "loc_lon"}
AIR_HIDDEN = RADIATION_HIDDEN | {"lnd_7128ec", "lnd_7318c", "lnd_7318u"}


def _where(condition: str, columns: str = "*") -> str:
    return sql_with(f"SELECT {columns} FROM m WHERE {condition}", "m")


# Time ------------------------------------------------------------------------


def _last(name: str, **span) -> None:
    since = AS_OF - timedelta(**span)

    @query(name, _where(f"when_captured >= {ts(since)}"))
    def run(spark, sf):
        return flt.last(measurements(spark, sf), AS_OF, **span)


_last("filter_last_24h", hours=24)
_last("filter_last_7d", days=7)
_last("filter_last_30d", days=30)
_last("filter_last_90d", days=90)


@query("filter_time_range", _where(RANGE))
def filter_time_range(spark, sf):
    return flt.time_filter(measurements(spark, sf), FROM, TO)


@query("filter_time_range_iso", _where(RANGE))
def filter_time_range_iso(spark, sf):
    """The same range as the texts a dashboard sends."""
    return flt.time_filter(measurements(spark, sf), FROM.isoformat(), TO.isoformat())


@query(
    "filter_last_6h",
    _where(f"when_captured BETWEEN {ts(AS_OF - timedelta(hours=6))} AND {ts(AS_OF)}"),
)
def filter_last_6h(spark, sf):
    """The dashboards' range when none is chosen."""
    return flt.time_filter(measurements(spark, sf), AS_OF - timedelta(hours=6), AS_OF)


@query("filter_between", _where("when_captured BETWEEN '2024-01-05' AND '2024-01-12'"))
def filter_between(spark, sf):
    return flt.time_filter(measurements(spark, sf), "2024-01-05", "2024-01-12")


@query("filter_sane_upper", _where("when_captured < TIMESTAMP '2030-01-01'"))
def filter_sane_upper(spark, sf):
    return flt.sane_upper(measurements(spark, sf))


@query("purge_future", _where(f"NOT (when_captured > {ts(EARLY)} + INTERVAL 1 DAY)"))
def purge_future_query(spark, sf):
    return purge_future(measurements(spark, sf), EARLY)


@query("retention_delete", _where(f"NOT (when_captured < {ts(EARLY)} - INTERVAL 14 DAY)"))
def retention_delete(spark, sf):
    return retain(measurements(spark, sf), EARLY, days=14)


@query(
    "filter_after_watermark",
    _where(
        "when_captured > (SELECT COALESCE(MAX(when_captured), TIMESTAMP '1970-01-01')"
        f" FROM m WHERE when_captured < {ts(HELD_UNTIL)})",
    ),
)
def filter_after_watermark(spark, sf):
    facts = measurements(spark, sf)
    state = measurements(spark, sf, TIME).filter(F.col(TIME) < moment(HELD_UNTIL))
    synced = state.agg(
        F.lit("measurements").alias("table_name"), F.max(TIME).alias("last_sync_timestamp")
    )
    return flt.after_watermark(facts, last_sync(synced, "measurements"))


@query(
    "filter_from_max_bucket",
    sql_with(
        "SELECT m.* FROM m WHERE when_captured >= (SELECT COALESCE(MAX(hour),"
        f" {ts(AS_OF)} - INTERVAL 30 DAY) FROM h WHERE hour < {ts(HELD_UNTIL)})",
        "h",
    ),
)
def filter_from_max_bucket(spark, sf):
    held = hourly(spark, sf).filter(F.col("hour") < moment(HELD_UNTIL))
    return flt.from_newest_bucket(
        measurements(spark, sf), held, "hour", AS_OF - timedelta(days=30)
    )


@query("filter_from_max_day", _where("when_captured >= TIMESTAMP '2000-01-01'"))
def filter_from_max_day(spark, sf):
    """An empty daily rollup: everything since the default start."""
    facts = measurements(spark, sf)
    held = empty_clone(daily_summary(facts))
    return flt.from_newest_bucket(facts, held, "day", "2000-01-01 00:00:00")


@query(
    "filter_from_newest_day",
    sql_with(
        "SELECT m.* FROM m WHERE when_captured >= (SELECT MAX(day) FROM d"
        f" WHERE day < CAST({ts(HELD_UNTIL)} AS DATE))",
        "d",
    ),
)
def filter_from_newest_day(spark, sf):
    """A filled daily rollup: everything since the start of its newest day."""
    facts = measurements(spark, sf)
    held = daily_summary(facts).filter(F.col("day") < F.lit(HELD_UNTIL.date()))
    return flt.from_newest_bucket(facts, held, "day", "2000-01-01 00:00:00")


# Values ----------------------------------------------------------------------


@query("filter_in_list", _where(f"device_urn IN ({DEVICE_LIST})"))
def filter_in_list(spark, sf):
    return flt.in_list(measurements(spark, sf), "device_urn", DEVICES)


@query("filter_in_long_list", _where("CAST(device_sn AS INTEGER) BETWEEN 65100 AND 67099"))
def filter_in_long_list(spark, sf):
    """More serial numbers than fit a predicate, as a relation of keys."""
    wanted = spark.range(65100, 67100).select(F.col("id").cast("string").alias("device_sn"))
    return flt.in_relation(measurements(spark, sf), "device_sn", wanted)


@query(
    "filter_in_relation",
    _where("device_urn IN (SELECT device_urn FROM m WHERE lnd_7318u > 150)"),
)
def filter_in_relation(spark, sf):
    """All readings of the devices that ever read high: the keys come from the table itself."""
    facts = measurements(spark, sf)
    high = facts.filter(F.col("lnd_7318u") > 150)
    return flt.in_relation(facts, "device_urn", high)


@query(
    "filter_lookup_relation",
    _where("device IN (SELECT user_id FROM events WHERE event_type = 'error') AND loc_name = 'AMERICA'"),
)
def filter_lookup_relation(spark, sf):
    """A relation of keys and a value together."""
    events = spark.read.parquet(f"{sf}/events.parquet").filter(F.col("event_type") == "error")
    return flt.lookup(measurements(spark, sf), device=events.select("user_id"), loc_name="AMERICA")


@query("filter_device", _where("device_urn = 'mobile:1'"))
def filter_device(spark, sf):
    return flt.equals(measurements(spark, sf), "device_urn", "mobile:1")


@query(
    "filter_device_24h",
    _where(f"device_urn = 'mobile:1' AND when_captured >= {ts(AS_OF - timedelta(hours=24))}"),
)
def filter_device_24h(spark, sf):
    return flt.last(filter_device(spark, sf), AS_OF, hours=24)


@query("filter_country", _where("loc_country = 'NATION_7'"))
def filter_country(spark, sf):
    return flt.equals(measurements(spark, sf), "loc_country", "NATION_7")


@query(
    "filter_country_7d",
    _where(f"loc_country = 'NATION_7' AND when_captured >= {ts(AS_OF - timedelta(days=7))}"),
)
def filter_country_7d(spark, sf):
    return flt.last(filter_country(spark, sf), AS_OF, days=7)


@query("filter_lookup", _where("device IN (1, 7, 14) AND loc_name = 'AMERICA'"))
def filter_lookup(spark, sf):
    return flt.lookup(
        measurements(spark, sf), device=[1, 7, 14], loc_name="AMERICA", loc_lat=None, device_sn=None
    )


@query("filter_lookup_sn", _where("device_sn = '65003' AND loc_lat = -87"))
def filter_lookup_sn(spark, sf):
    return flt.lookup(measurements(spark, sf), device_sn="65003", loc_lat=-87.0)


@query(
    "filter_sentinel",
    _where("lnd_7318u > 0 AND loc_lat != 0 AND loc_lon != 0"),
)
def filter_sentinel(spark, sf):
    return measurements(spark, sf).filter(flt.has_radiation() & flt.has_position())


@query("filter_sentinel_air", _where("pms_pm02_5 != '0'"))
def filter_sentinel_air(spark, sf):
    return measurements(spark, sf).filter(flt.has_air())


@query("filter_not_null", _where("loc_country IS NOT NULL"))
def filter_not_null(spark, sf):
    return measurements(spark, sf).filter(F.col("loc_country").isNotNull())


@query("filter_text", _where("lower(device_urn) LIKE '%mobile:1%'"))
def filter_text(spark, sf):
    return flt.text_search(measurements(spark, sf), "device_urn", "Mobile:1")


# Projections -----------------------------------------------------------------


@query(
    "project_alias",
    sql_with("SELECT hour AS time, device_urn AS metric, avg_radiation AS value FROM h", "h"),
)
def project_alias(spark, sf):
    return hourly(spark, sf).select(
        F.col("hour").alias("time"),
        F.col("device_urn").alias("metric"),
        F.col("avg_radiation").alias("value"),
    )


@query(
    "organize_columns",
    sql_with(
        "SELECT when_captured, device_urn, lnd_7128ec, lnd_7318c, lnd_7318u, pms_pm02_5,"
        " bat_voltage, loc_country, loc_name FROM m",
        "m",
    ),
)
def organize_columns(spark, sf):
    return organize(measurements(spark, sf), TABLE_ORDER, RADIATION_HIDDEN)


@query(
    "organize_columns_air",
    sql_with(
        "SELECT when_captured, device_urn, pms_pm02_5, bat_voltage, loc_country, loc_name FROM m",
        "m",
    ),
)
def organize_columns_air(spark, sf):
    return organize(measurements(spark, sf), TABLE_ORDER, AIR_HIDDEN)


@query(
    "literal_column",
    sql_with("SELECT 'hourly_summary' AS table_name, hour, device_urn FROM h", "h"),
)
def literal_column(spark, sf):
    return hourly(spark, sf).select(
        F.lit("hourly_summary").alias("table_name"), "hour", "device_urn"
    )


@query(
    "order_by",
    sql_with("SELECT device_urn, when_captured, lnd_7318u FROM m ORDER BY 1, 2 DESC", "m"),
)
def order_by(spark, sf):
    rows = measurements(spark, sf, "device_urn", TIME, "lnd_7318u")
    return rows.orderBy(
        F.col("device_urn").asc_nulls_last(), F.col(TIME).desc_nulls_last(), "lnd_7318u"
    )


def _limit(n: int) -> str:
    return sql_with(
        f"SELECT {n} AS top, device_urn, when_captured, lnd_7318u FROM"
        " (SELECT * FROM m ORDER BY lnd_7318u DESC, when_captured DESC, device_urn"
        f" LIMIT {n})",
        "m",
    )


@query("limit_n", " UNION ALL ".join(f"({_limit(n)})" for n in (10, 20, 100, 1000, 5000)))
def limit_n(spark, sf):
    """The readings with the highest counts, for each of the panels' limits."""
    rows = measurements(spark, sf, "device_urn", TIME, "lnd_7318u")
    order = [F.desc("lnd_7318u"), F.desc(TIME), "device_urn"]
    widest = materialise(rows.orderBy(*order).limit(5000), "top")
    ranked = widest.orderBy(*order)
    return union_all(
        *(ranked.limit(n).select(F.lit(n).alias("top"), "*") for n in (10, 20, 100, 1000, 5000))
    )


@query("distinct_devices", _where("device_urn != ''", "DISTINCT device_urn"))
def distinct_devices(spark, sf):
    devices = measurements(spark, sf, "device_urn").distinct()
    return devices.filter(F.col("device_urn") != "")


# Scalar functions ------------------------------------------------------------


@query("safe_name", sql_with("SELECT device_urn, replace(device_urn, ':', '_') AS name FROM m", "m"))
def safe_name_query(spark, sf):
    rows = measurements(spark, sf, "device_urn")
    return rows.select("device_urn", safe_name(F.col("device_urn")).alias("name"))


def _bucket(name: str, sql: str, make) -> None:
    @query(name, sql_with(f"SELECT device, when_captured, {sql} AS bucket FROM m", "m"))
    def run(spark, sf):
        rows = measurements(spark, sf, "device", TIME)
        return rows.select("device", TIME, make(F.col(TIME)).alias("bucket"))


_bucket("date_trunc_hour", "date_trunc('hour', when_captured)", timebuckets.hour_of)
_bucket("date_trunc_day", "date_trunc('day', when_captured)::TIMESTAMP", timebuckets.day_start)
_bucket("cast_date", "CAST(when_captured AS DATE)", timebuckets.day_of)
_bucket("year_of", "CAST(year(when_captured) AS INTEGER)", timebuckets.year_of)
_bucket(
    "date_trunc_interval",
    "time_bucket(INTERVAL '15 minutes', when_captured)",
    lambda time: timebuckets.bucket(time, "15 minutes"),
)


@query(
    "now_minus_interval",
    sql_with(
        f"SELECT COUNT(*) FILTER (when_captured >= {ts(AS_OF)} - INTERVAL 24 HOUR) AS last_24h,"
        f" COUNT(*) FILTER (when_captured >= {ts(AS_OF)} - INTERVAL 7 DAY) AS last_7d,"
        f" COUNT(*) FILTER (when_captured >= {ts(AS_OF)} - INTERVAL 30 DAY) AS last_30d FROM m",
        "m",
    ),
)
def now_minus_interval(spark, sf):
    facts = measurements(spark, sf, TIME)
    spans = {"last_24h": {"hours": 24}, "last_7d": {"days": 7}, "last_30d": {"days": 30}}
    return facts.agg(
        *[
            F.count_if(F.col(TIME) >= moment(AS_OF - timedelta(**span))).alias(name)
            for name, span in spans.items()
        ]
    )


@query(
    "epoch_days",
    sql_with(
        f"SELECT device, when_captured, (epoch_us({ts(AS_OF)}) - epoch_us(when_captured))"
        " / 1e6 / 86400 AS age_days FROM m",
        "m",
    ),
)
def epoch_days(spark, sf):
    rows = measurements(spark, sf, "device", TIME)
    age = timebuckets.epoch_days(moment(AS_OF), F.col(TIME)).alias("age_days")
    return rows.select("device", TIME, age)


@query(
    "z_score_expr",
    sql_rounded(
        sql_with(
            "SELECT m.device_urn, m.when_captured, (m.lnd_7318u - s.avg_radiation) /"
            " NULLIF(s.stddev_radiation, 0) AS z_score FROM m JOIN s USING (device_urn)",
            "m",
            s=DEVICE_STATS_SQL,
        ),
        "z_score",
    ),
)
def z_score_expr(spark, sf):
    facts = measurements(spark, sf, "device_urn", "lnd_7318u", TIME)
    score = z_score(F.col("lnd_7318u"), F.col("avg_radiation"), F.col("stddev_radiation"))
    joined = join_device_stats(facts, device_radiation_stats(facts))
    return rounded(joined.select("device_urn", TIME, score.alias("z_score")), "z_score")


@query(
    "join_stats",
    sql_rounded(
        sql_with(
            "SELECT m.device_urn, m.when_captured, m.lnd_7318u, s.avg_radiation,"
            " s.stddev_radiation FROM m JOIN s ON m.device_urn = s.device_urn",
            "m",
            s=DEVICE_STATS_SQL,
        ),
        "avg_radiation",
        "stddev_radiation",
    ),
)
def join_stats(spark, sf):
    facts = measurements(spark, sf, "device_urn", TIME, "lnd_7318u")
    joined = join_device_stats(facts, device_radiation_stats(facts))
    return rounded(joined, "avg_radiation", "stddev_radiation")


@query(
    "join_scalar",
    sql_with(
        "SELECT m.device, m.when_captured, (SELECT MAX(when_captured) FROM m) AS last_ts,"
        " (SELECT COUNT(*) FROM m) AS new_rows FROM m",
        "m",
    ),
)
def join_scalar(spark, sf):
    facts = measurements(spark, sf, "device", TIME)
    return facts.select(
        "device",
        TIME,
        facts.agg(F.max(TIME)).scalar().alias("last_ts"),
        facts.agg(F.count(F.lit(1))).scalar().alias("new_rows"),
    )


@query(
    "concat_message",
    sql_with(
        "SELECT loc_country, 'Synced ' || COUNT(*) || ' new measurements' AS status FROM m"
        " GROUP BY loc_country",
        "m",
    ),
)
def concat_message(spark, sf):
    counts = measurements(spark, sf, "loc_country").groupBy("loc_country").count()
    return counts.select("loc_country", sync_message(F.col("count")).alias("status"))


# Threshold classes -----------------------------------------------------------


@query(
    "classify_radiation",
    sql_with(
        "SELECT device, when_captured, lnd_7318u, CASE WHEN lnd_7318u >= 60 THEN 'dark-red'"
        " WHEN lnd_7318u >= 40 THEN 'super-light-red' WHEN lnd_7318u >= 20 THEN 'orange'"
        " WHEN lnd_7318u >= 15 THEN 'yellow' WHEN lnd_7318u >= 10 THEN 'super-light-green'"
        " WHEN lnd_7318u >= 5 THEN 'green' ELSE 'dark-green' END AS class FROM m",
        "m",
    ),
)
def classify_radiation(spark, sf):
    rows = measurements(spark, sf, "device", TIME, "lnd_7318u")
    return rows.select("*", classify.classify_radiation(F.col("lnd_7318u")).alias("class"))


@query(
    "classify_air",
    sql_with(
        "SELECT device, when_captured, pm25, CASE WHEN pm25 >= 20 THEN 'super-light-red'"
        " WHEN pm25 >= 10 THEN 'light-orange' WHEN pm25 >= 4 THEN 'light-blue'"
        " WHEN pm25 >= 1 THEN 'light-yellow' ELSE 'super-light-green' END AS class FROM"
        " (SELECT *, TRY_CAST(pms_pm02_5 AS DOUBLE) AS pm25 FROM m)",
        "m",
    ),
)
def classify_air(spark, sf):
    rows = measurements(spark, sf, "device", TIME, "pms_pm02_5")
    pm25 = to_double(F.col("pms_pm02_5")).alias("pm25")
    return rows.select("device", TIME, pm25).select(
        "*", classify.classify_air(F.col("pm25")).alias("class")
    )


@query(
    "classify_cell",
    sql_with(
        "SELECT device, when_captured, dev_temp,"
        " CASE WHEN dev_temp >= 80 THEN 'red' ELSE 'green' END AS class FROM m",
        "m",
    ),
)
def classify_cell(spark, sf):
    rows = measurements(spark, sf, "device", TIME, "dev_temp")
    return rows.select("*", classify.classify_cell(F.col("dev_temp")).alias("class"))


@query(
    "classify_latency",
    "SELECT event_id, value * 10 AS millis, CASE WHEN value * 10 > 2000 THEN 'Poor'"
    " WHEN value * 10 >= 500 THEN 'Moderate' WHEN value * 10 >= 100 THEN 'Good'"
    " ELSE 'Excellent' END AS rating FROM events",
)
def classify_latency(spark, sf):
    """Event values read as query times of ten times as many milliseconds."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    timed = events.select("event_id", (F.col("value") * 10).alias("millis"))
    return timed.select("*", classify.classify_latency(F.col("millis")).alias("rating"))
