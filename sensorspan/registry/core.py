"""Registration of queries, and the telemetry views over the given tables.

The given ``events`` are read as device readings: a user is a device, an
event's value is what one of the device's sensors reported. The column
expressions below are plain SQL that both engines evaluate; each query proper
is written once for Spark and once, separately, as SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import materialise
from ..operators.rollups import daily_summary, hourly_summary, recent_data
from ..schema import FEED_FIELDS, MEASUREMENT_COLUMNS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# "Now": just after the last event.
AS_OF = datetime(2024, 1, 31)
# A "now" inside the data, for what counts as future.
EARLY = datetime(2024, 1, 25)
# The dashboard's time range.
FROM = datetime(2024, 1, 10, 6)
TO = datetime(2024, 1, 20, 18)
# Loads: the table held readings before HELD_UNTIL; the next feed starts earlier.
HELD_UNTIL = datetime(2024, 1, 20)
FEED_FROM = datetime(2024, 1, 15)
DEVICES = ("fixed:3", "mobile:1", "mobile:7", "air:2", "air:14")

READING_K = {
    "spark": "CAST(get_json_object(props, '$.k') AS BIGINT)",
    "duckdb": "CAST(json_extract_string(props, '$.k') AS BIGINT)",
}

# Columns of the fact table from an event ``e``, its nation ``n``, region ``r``.
MEASUREMENT_SQL = {
    "bat_voltage": "'3.7'",
    "dev_temp": "{k} + 5",
    "device": "user_id",
    "device_sn": "CAST(user_id + 65000 AS STRING)",
    "device_urn": (
        "CASE user_id % 3 WHEN 0 THEN 'fixed:' WHEN 1 THEN 'mobile:' ELSE 'air:' END"
        " || CAST(user_id AS STRING)"
    ),
    "device_filename": (
        "CASE user_id % 3 WHEN 0 THEN 'fixed_' WHEN 1 THEN 'mobile_' ELSE 'air_' END"
        " || CAST(user_id AS STRING) || '.json'"
    ),
    "env_temp": "{k}",
    "lnd_7128ec": "CASE WHEN event_type = 'error' THEN CAST(value AS STRING) ELSE '0' END",
    "lnd_7318c": "CASE WHEN event_type = 'signup' THEN CAST(value AS STRING) ELSE '0' END",
    "lnd_7318u": (
        "CASE WHEN event_type IN ('view', 'click') THEN CAST(floor(value) AS BIGINT)"
        " ELSE CAST(0 AS BIGINT) END"
    ),
    "loc_country": "n_name",
    "loc_lat": "CAST(CASE WHEN user_id % 10 = 0 THEN 0 ELSE user_id % 180 - 90 END AS DOUBLE)",
    "loc_lon": "CAST(CASE WHEN user_id % 10 = 0 THEN 0 ELSE user_id % 360 - 180 END AS DOUBLE)",
    "loc_name": "r_name",
    "pms_pm02_5": "CASE WHEN event_type = 'purchase' THEN CAST(value AS STRING) ELSE '0' END",
    "when_captured": "ts",
}

# A raw feed: the same readings as text, with every kind of defect a device sends.
_STAMP = "replace(CAST(ts AS STRING), ' ', 'T') || 'Z'"
FEED_SQL = {
    "when_captured": (
        "CASE WHEN {k} = 1 THEN NULL WHEN {k} = 2 THEN '' WHEN {k} = 3 THEN '2012-00-00T00:00:00Z'"
        " WHEN {k} = 4 THEN '2024-11' WHEN {k} = 5 THEN 'soon'"
        f" WHEN {{k}} = 6 THEN '2080-01-09 00:00:00' ELSE {_STAMP} END"
    ),
    "device_urn": (
        "CASE WHEN {k} = 11 THEN NULL WHEN {k} = 12 THEN '' WHEN {k} = 13 THEN '0'"
        " WHEN {k} = 14 THEN 'a:\"' || CAST(user_id AS STRING) ELSE " + MEASUREMENT_SQL["device_urn"]
        + " END"
    ),
    "device_sn": "CASE WHEN {k} = 15 THEN NULL ELSE CAST(user_id + 65000 AS STRING) END",
    "device": (
        "CASE WHEN {k} = 16 THEN NULL WHEN {k} = 17 THEN 'abc' WHEN {k} = 18 THEN"
        " CAST(user_id AS STRING) || '.5' WHEN {k} = 19 THEN '1e3' ELSE CAST(user_id AS STRING) END"
    ),
    "loc_name": "CASE WHEN {k} = 21 THEN NULL ELSE event_type END",
    "loc_country": "CASE WHEN {k} = 22 THEN NULL WHEN {k} = 23 THEN '' ELSE 'JP' END",
    "loc_lat": (
        "CASE WHEN {k} = 24 THEN NULL WHEN {k} = 25 THEN '' WHEN {k} = 26 THEN 'x'"
        " ELSE CAST(user_id % 90 AS STRING) || '.25' END"
    ),
    "loc_lon": "CASE WHEN {k} = 27 THEN NULL ELSE '-' || CAST(user_id % 180 AS STRING) || '.5' END",
    "env_temp": (
        "CASE WHEN {k} = 31 THEN NULL WHEN {k} = 32 THEN '' WHEN {k} = 33 THEN 'hot'"
        " ELSE CAST({k} AS STRING) || '.5' END"
    ),
    "lnd_7318c": "CASE WHEN event_type = 'signup' THEN CAST(value AS STRING) ELSE NULL END",
    "lnd_7318u": (
        "CASE WHEN {k} = 34 THEN NULL WHEN {k} = 35 THEN ''"
        " WHEN event_type IN ('view', 'click') THEN CAST(value AS STRING) ELSE '0.0' END"
    ),
    "lnd_7128ec": "CASE WHEN event_type = 'error' THEN CAST(value AS STRING) ELSE '' END",
    "pms_pm02_5": "CASE WHEN event_type = 'purchase' THEN CAST(value AS STRING) ELSE NULL END",
    "bat_voltage": "CASE WHEN {k} = 41 THEN NULL WHEN {k} = 42 THEN '' ELSE '3.7' END",
    "dev_temp": "CASE WHEN {k} = 43 THEN NULL ELSE CAST({k} - 20 AS STRING) END",
}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


# Spark views -----------------------------------------------------------------


def measurements(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The fact table, or some of its columns, over the given events.

    Country and region names are looked up only when asked for. The lookup
    tables are joined without a hint: the planner sees their file sizes.
    """
    names = columns or MEASUREMENT_COLUMNS
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    if {"loc_country", "loc_name"} & set(names):
        nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
        rows = rows.join(nation, nation.n_nationkey == rows.user_id % 25)
    if "loc_name" in names:
        region = spark.read.parquet(f"{sf_dir}/region.parquet")
        rows = rows.join(region, rows.n_regionkey == region.r_regionkey)
    rows = rows.withColumn("k", F.expr(READING_K["spark"]))
    return rows.select(
        *[F.expr(MEASUREMENT_SQL[name].format(k="k")).alias(name) for name in names]
    )


_LANDED: dict[tuple[str, str], DataFrame] = {}


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with repeats: every object once more, just after, with another value.

    It is written once per application, as a landed feed would be.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        rows = spark.read.parquet(f"{sf_dir}/events.parquet")
        once = rows.withColumn("k", F.expr(READING_K["spark"])).select(
            (F.col("event_id") * 2).alias("pos"),
            *[F.expr(FEED_SQL[name].format(k="k")).alias(name) for name in FEED_FIELDS],
        )
        again = once.withColumn("pos", F.col("pos") + 1).withColumn("bat_voltage", F.lit("9.9"))
        _LANDED[key] = materialise(once.unionByName(again), "feed")
    return _LANDED[key]


def hourly(spark, sf_dir, since=None, until=None) -> DataFrame:
    return hourly_summary(measurements(spark, sf_dir), AS_OF, since=since, until=until)


def daily(spark, sf_dir, since=None, until=None) -> DataFrame:
    return daily_summary(measurements(spark, sf_dir), since=since, until=until)


def recent(spark, sf_dir, *columns) -> DataFrame:
    return recent_data(measurements(spark, sf_dir, *columns), AS_OF)


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """Round means of fractions, whose last digits depend on the order of adding."""
    return df.select(
        *[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


# SQL views -------------------------------------------------------------------


def ts(value: datetime) -> str:
    return f"TIMESTAMP '{value.isoformat(sep=' ')}'"


def _select(expressions: dict[str, str]) -> str:
    k = READING_K["duckdb"]
    return ", ".join(f"{sql.format(k=k)} AS {name}" for name, sql in expressions.items())


_VIEWS = {
    "m": (
        (),
        f"SELECT {_select(MEASUREMENT_SQL)} FROM events"
        " JOIN nation ON n_nationkey = user_id % 25 JOIN region ON r_regionkey = n_regionkey",
    ),
    "h": (
        ("m",),
        "SELECT date_trunc('hour', when_captured) AS hour, device_urn, device_sn, loc_country,"
        " loc_name, loc_lat, loc_lon, COUNT(*) AS reading_count,"
        " AVG(CAST(lnd_7318u AS DOUBLE)) AS avg_radiation,"
        " MAX(CAST(lnd_7318u AS DOUBLE)) AS max_radiation,"
        " MIN(CAST(lnd_7318u AS DOUBLE)) AS min_radiation,"
        " AVG(CAST(env_temp AS DOUBLE)) AS avg_temp, MAX(CAST(env_temp AS DOUBLE)) AS max_temp,"
        " MIN(CAST(env_temp AS DOUBLE)) AS min_temp"
        f" FROM m WHERE when_captured >= {ts(AS_OF)} - INTERVAL 30 DAY"
        " GROUP BY 1, 2, 3, 4, 5, 6, 7",
    ),
    "d": (
        ("m",),
        "SELECT CAST(when_captured AS DATE) AS day, device_urn, device_sn, loc_country,"
        " loc_name, loc_lat, loc_lon, COUNT(*) AS reading_count,"
        " AVG(CAST(lnd_7318u AS DOUBLE)) AS avg_radiation,"
        " MAX(CAST(lnd_7318u AS DOUBLE)) AS max_radiation,"
        " MIN(CAST(lnd_7318u AS DOUBLE)) AS min_radiation,"
        " AVG(CAST(env_temp AS DOUBLE)) AS avg_temp, MAX(CAST(env_temp AS DOUBLE)) AS max_temp,"
        " MIN(CAST(env_temp AS DOUBLE)) AS min_temp"
        " FROM m GROUP BY 1, 2, 3, 4, 5, 6, 7",
    ),
    "r": (
        ("m",),
        f"SELECT * FROM m WHERE when_captured >= {ts(AS_OF)} - INTERVAL 7 DAY",
    ),
    "once": ((), f"SELECT event_id * 2 AS pos, {_select(FEED_SQL)} FROM events"),
    "f": (
        ("once",),
        "SELECT * FROM once UNION ALL SELECT * REPLACE ('9.9' AS bat_voltage,"
        " pos + 1 AS pos) FROM once",
    ),
}


def sql_with(body: str, *views: str, **extra: str) -> str:
    """``body`` with the named views, and what they need, in front of it."""
    needed: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in needed:
            before, text = _VIEWS[name]
            for other in before:
                add(other)
            needed[name] = text

    for view in views:
        add(view)
    needed.update(extra)
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in needed.items()) + " " + body


def sql_rounded(body: str, *columns: str, digits: int = 9) -> str:
    """``body`` with some columns rounded like ``rounded`` does."""
    replaced = ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({body}) AS unrounded"
