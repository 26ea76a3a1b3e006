"""Dashboard panels and analysis queries over the fact table and its rollups.

``facts`` is the measurements table, ``hourly`` and ``daily`` are rollups.
Times relative to now are relative to ``as_of``. Sorted results have enough
keys for one possible order; a limit is there only where the panel shows the
top of such an order.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import to_double
from ..functions.stats import z_score
from ..functions.timebuckets import day_of, day_start, epoch_days, hour_of
from ..operators.filters import (
    TIME,
    has_air,
    has_position,
    has_radiation,
    in_list,
    last,
    sane_upper,
    time_filter,
)
from ..operators.joins import device_radiation_stats, join_device_stats

def _rows() -> Column:
    return F.count(F.lit(1))


def _newest_first(df: DataFrame, time: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(time).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


# Rollup panels -------------------------------------------------------------


def radiation_over_time(
    hourly: DataFrame, frm: datetime, to: datetime, devices: Iterable[str]
) -> DataFrame:
    """Hourly mean of chosen devices as time, metric, value."""
    chosen = in_list(time_filter(hourly, frm, to, "hour"), "device_urn", devices)
    return chosen.select(
        F.col("hour").alias("time"),
        F.col("device_urn").alias("metric"),
        F.col("avg_radiation").alias("value"),
    ).orderBy("time", "metric", "value")


def all_devices_24h(hourly: DataFrame, as_of: datetime, limit: int = 1000) -> DataFrame:
    rows = last(hourly, as_of, "hour", hours=24).select(
        F.col("hour").alias("time"), "device_urn", "avg_radiation", "reading_count", "loc_country"
    )
    ties = ("device_urn", "loc_country", "reading_count", "avg_radiation")
    return _newest_first(rows, "time", *ties).limit(limit)


def device_list_latest(hourly: DataFrame, as_of: datetime) -> DataFrame:
    """Devices of the last week; the mean is over hours, whatever their counts."""
    return _newest_first(
        last(hourly, as_of, "hour", days=7)
        .groupBy("device_urn")
        .agg(
            F.max("hour").alias("last_seen"),
            F.avg("avg_radiation").alias("avg_radiation"),
            F.sum("reading_count").alias("total_readings"),
            F.min_by("loc_country", F.struct("hour", "loc_country")).alias("country"),
        ),
        "last_seen",
        "device_urn",
    )


def geo_distribution(hourly: DataFrame, as_of: datetime) -> DataFrame:
    return _newest_first(
        last(hourly, as_of, "hour", days=7)
        .groupBy(F.col("loc_country").alias("country"))
        .agg(
            F.count_distinct("device_urn").alias("device_count"),
            F.avg("avg_radiation").alias("avg_radiation"),
            F.sum("reading_count").alias("total_readings"),
        ),
        "device_count",
        "country",
    )


def stats_panel(hourly: DataFrame, as_of: datetime) -> DataFrame:
    return last(hourly, as_of, "hour", hours=24).agg(
        F.count_distinct("device_urn").alias("active_devices"),
        F.avg("avg_radiation").alias("avg_radiation"),
        F.max("max_radiation").alias("max_radiation"),
        F.sum("reading_count").alias("total_readings"),
    )


def summary_series_24h(hourly: DataFrame, as_of: datetime) -> DataFrame:
    return (
        last(hourly, as_of, "hour", hours=24)
        .select(F.col("hour").alias("time"), "device_sn", "avg_radiation", "avg_temp")
        .orderBy("time", "device_sn", "avg_radiation", "avg_temp")
    )


def summary_metric_24h(hourly: DataFrame, as_of: datetime) -> DataFrame:
    return (
        last(hourly, as_of, "hour", hours=24)
        .select(
            F.col("hour").alias("time"),
            F.col("device_urn").alias("metric"),
            F.col("avg_radiation").alias("value"),
        )
        .orderBy("time", "metric", "value")
    )


def summary_all_24h(hourly: DataFrame, as_of: datetime, limit: int | None = None) -> DataFrame:
    rows = last(hourly, as_of, "hour", hours=24)
    if limit is None:
        return rows
    ties = [name for name in rows.columns if name != "hour"]
    return _newest_first(rows, "hour", *ties).limit(limit)


# Series by range -----------------------------------------------------------


def _series(
    df: DataFrame, column: str, value: str, frm: datetime, to: datetime, devices: Iterable[str]
) -> DataFrame:
    """Time, device, radiation of chosen devices, from any of the tables."""
    typed = df.withColumn(column, F.col(column).cast("timestamp_ntz")) if column == "day" else df
    return (
        in_list(time_filter(typed, frm, to, column), "device_urn", devices)
        .select(
            F.col(column).alias("time"),
            "device_urn",
            F.col(value).cast("double").alias("radiation"),
        )
        .orderBy("time", "device_urn", "radiation")
    )


def recent_series(recent, frm, to, devices) -> DataFrame:
    return _series(recent, TIME, "lnd_7318u", frm, to, devices)


def monthly_series(hourly, frm, to, devices) -> DataFrame:
    return _series(hourly, "hour", "avg_radiation", frm, to, devices)


def yearly_series(daily, frm, to, devices) -> DataFrame:
    return _series(daily, "day", "avg_radiation", frm, to, devices)


# The widest range each table serves.
TIERS = ((timedelta(days=7), "recent"), (timedelta(days=30), "hourly"), (timedelta(days=366), "daily"))


def tier_of(frm: datetime, as_of: datetime) -> str:
    """The coarsest-enough table for a range that starts at ``frm``."""
    for span, tier in TIERS:
        if as_of - frm <= span:
            return tier
    return "facts"


def tier_route(tables: dict, frm: datetime, to: datetime, devices, as_of: datetime) -> DataFrame:
    """A radiation series from the table that fits the requested range.

    ``tables`` maps a tier's name to its DataFrame.
    """
    tier = tier_of(frm, as_of)
    if tier == "hourly":
        return monthly_series(tables[tier], frm, to, devices)
    if tier == "daily":
        return yearly_series(tables[tier], frm, to, devices)
    return recent_series(tables[tier], frm, to, devices)


# Raw panels ----------------------------------------------------------------


def recent_detail(
    recent: DataFrame, frm: datetime, to: datetime, limit: int = 5000
) -> DataFrame:
    rows = time_filter(recent, frm, to).select(
        F.col(TIME).alias("time"),
        F.col("device_urn").alias("metric"),
        F.col("lnd_7318u").cast("double").alias("radiation"),
        "loc_lat",
        "loc_lon",
        "loc_country",
    )
    ties = ("metric", "radiation", "loc_lat", "loc_lon", "loc_country")
    return _newest_first(rows, "time", *ties).limit(limit)


def recent_24h(recent: DataFrame, as_of: datetime) -> DataFrame:
    rows = last(recent, as_of, hours=24).select(
        F.col(TIME).alias("time"), "device_urn", F.col("lnd_7318u").alias("radiation")
    )
    return _newest_first(rows, "time", "device_urn", "radiation")


def fact_series_range(
    facts: DataFrame, frm: datetime, to: datetime, limit: int = 10_000
) -> DataFrame:
    rows = time_filter(facts, frm, to).select(
        F.col(TIME).alias("time"),
        "device_urn",
        F.col("lnd_7318u").cast("double").alias("radiation"),
        "loc_country",
    )
    return _newest_first(rows, "time", "device_urn", "radiation", "loc_country").limit(limit)


def fact_recent_limit(
    facts: DataFrame, as_of: datetime, limit: int = 10_000, **span: float
) -> DataFrame:
    rows = last(facts, as_of, **(span or {"days": 7}))
    ties = [name for name in rows.columns if name != TIME]
    return _newest_first(rows, TIME, "device", *ties).limit(limit)


# Table statistics ----------------------------------------------------------


def count_all(facts: DataFrame) -> DataFrame:
    return facts.agg(_rows().alias("total"))


def basic_stats(facts: DataFrame) -> DataFrame:
    return facts.agg(
        _rows().alias("total_rows"),
        F.count_distinct("device_urn").alias("unique_devices"),
        F.min(TIME).alias("earliest"),
        F.max(TIME).alias("latest"),
    )


def freshness(facts: DataFrame) -> DataFrame:
    return facts.agg(F.max(TIME).alias("latest"), _rows().alias("total"))


def count_range_sane(facts: DataFrame) -> DataFrame:
    return sane_upper(facts).agg(
        _rows().alias("total"), F.min(TIME).alias("earliest"), F.max(TIME).alias("latest")
    )


def count_between(facts: DataFrame, frm: datetime, to: datetime) -> DataFrame:
    return time_filter(facts, frm, to).agg(_rows().alias("total"))


def device_count(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count_distinct("device_urn").alias("device_count"))


def device_count_approx(facts: DataFrame, error: float = 0.02) -> DataFrame:
    return facts.agg(F.approx_count_distinct("device_urn", error).alias("device_count"))


# Activity ------------------------------------------------------------------


def recent_device_activity(facts: DataFrame, limit: int = 10) -> DataFrame:
    rows = facts.groupBy("device_urn").agg(
        _rows().alias("measurement_count"), F.max(TIME).alias("last_seen")
    )
    return _newest_first(rows, "last_seen", "device_urn").limit(limit)


def device_agg_24h(facts: DataFrame, as_of: datetime, limit: int = 20) -> DataFrame:
    radiation = F.col("lnd_7318u").cast("double")
    rows = (
        last(facts, as_of, hours=24)
        .groupBy("device_urn")
        .agg(
            _rows().alias("reading_count"),
            F.avg(radiation).alias("avg_radiation"),
            F.max(radiation).alias("max_radiation"),
            F.min(TIME).alias("first_reading"),
            F.max(TIME).alias("last_reading"),
        )
    )
    return _newest_first(rows, "reading_count", "device_urn").limit(limit)


def daily_activity_7d(facts: DataFrame, as_of: datetime) -> DataFrame:
    rows = (
        last(facts, as_of, days=7)
        .groupBy(day_start(TIME).alias("day"))
        .agg(
            _rows().alias("readings_per_day"),
            F.count_distinct("device_urn").alias("active_devices"),
        )
    )
    return _newest_first(rows, "day")


def hourly_active_devices(facts: DataFrame, frm: datetime, to: datetime) -> DataFrame:
    return (
        time_filter(facts, frm, to)
        .groupBy(hour_of(TIME).alias("time"))
        .agg(F.count_distinct("device_urn").alias("active_devices"))
        .orderBy("time")
    )


def hourly_freshness(facts: DataFrame, as_of: datetime) -> DataFrame:
    return (
        last(facts, as_of, hours=24)
        .groupBy(hour_of(TIME).alias("time"))
        .agg(_rows().alias("readings_received"))
        .orderBy("time")
    )


def device_uptime(facts: DataFrame, frm: datetime, to: datetime) -> DataFrame:
    rows = (
        time_filter(facts, frm, to)
        .groupBy("device_urn")
        .agg(
            F.min(TIME).alias("first_seen"),
            F.max(TIME).alias("last_seen"),
            _rows().alias("total_readings"),
        )
        .withColumn("days_active", epoch_days(F.col("last_seen"), F.col("first_seen")))
    )
    return _newest_first(rows, "days_active", "device_urn")


def daily_stats_min(facts: DataFrame) -> DataFrame:
    return facts.groupBy(day_of(TIME).alias("day"), "device_urn").agg(
        _rows().alias("readings"), F.avg("lnd_7318u").alias("avg_radiation")
    )


def devices_avg_7d(facts: DataFrame, as_of: datetime, devices: Iterable[str]) -> DataFrame:
    return (
        in_list(last(facts, as_of, days=7), "device_urn", devices)
        .groupBy("device_urn")
        .agg(F.avg("lnd_7318u").alias("avg_radiation"))
    )


# Geography -----------------------------------------------------------------


def country_agg(facts: DataFrame, limit: int = 10) -> DataFrame:
    rows = (
        facts.filter(F.col("loc_country").isNotNull())
        .groupBy("loc_country")
        .agg(
            _rows().alias("reading_count"),
            F.count_distinct("device_urn").alias("devices"),
            F.avg(F.col("lnd_7318u").cast("double")).alias("avg_radiation"),
        )
    )
    return _newest_first(rows, "reading_count", "loc_country").limit(limit)


def country_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("loc_country").agg(_rows().alias("reading_count"))


def country_daily(facts: DataFrame, as_of: datetime) -> DataFrame:
    return (
        last(facts, as_of, days=30)
        .groupBy(day_start(TIME).alias("day"), "loc_country")
        .agg(F.avg("lnd_7318u").alias("avg_radiation"))
    )


def pm25_by_location(facts: DataFrame, frm: datetime, to: datetime) -> DataFrame:
    return (
        time_filter(facts, frm, to)
        .filter(has_air())
        .groupBy("loc_country", "loc_lat", "loc_lon")
        .agg(F.avg(to_double(F.col("pms_pm02_5"))).alias("avg_pm25"))
    )


def device_activity_map(facts: DataFrame, frm: datetime, to: datetime) -> DataFrame:
    return (
        time_filter(facts, frm, to)
        .filter(has_position())
        .groupBy(
            "device_urn",
            F.col("loc_lat").alias("latitude"),
            F.col("loc_lon").alias("longitude"),
            "loc_country",
        )
        .agg(
            _rows().alias("measurement_count"),
            F.max(TIME).alias("last_seen"),
            F.avg("lnd_7318u").alias("avg_radiation"),
        )
    )


# Radiation -----------------------------------------------------------------


def top_radiation(facts: DataFrame, frm: datetime, to: datetime, limit: int = 10) -> DataFrame:
    rows = (
        time_filter(facts, frm, to)
        .filter(has_radiation())
        .groupBy("device_urn")
        .agg(F.avg("lnd_7318u").alias("avg_radiation"), _rows().alias("reading_count"))
    )
    return _newest_first(rows, "avg_radiation", "device_urn").limit(limit)


def hourly_radiation_by_device(facts: DataFrame, frm: datetime, to: datetime) -> DataFrame:
    return (
        time_filter(facts, frm, to)
        .filter(has_radiation())
        .groupBy(hour_of(TIME).alias("time"), "device_urn")
        .agg(F.avg("lnd_7318u").alias("radiation"))
        .orderBy("time", "device_urn")
    )


def anomalies_zscore(
    facts: DataFrame,
    frm: datetime,
    to: datetime,
    threshold: float = 2.0,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Readings far above their device's mean.

    Mean and deviation come from all positive readings of all time; the
    readings compared with them are all readings of the range. Devices with
    one reading or with constant ones have no deviation and no anomalies.
    ``stats`` (the tables' ``radiation_stats``, or ``radiation_moments`` of any state) has
    them ready; without it they are computed from all facts.
    """
    rows = time_filter(facts, frm, to).select(TIME, "device_urn", "lnd_7318u")
    score = z_score(F.col("lnd_7318u"), F.col("avg_radiation"), F.col("stddev_radiation"))
    scored = join_device_stats(rows, device_radiation_stats(facts) if stats is None else stats).select(
        TIME, "device_urn", "lnd_7318u", "avg_radiation", score.alias("z_score")
    )
    far = scored.filter(F.col("z_score") > threshold)
    return _newest_first(far, TIME, "device_urn", "lnd_7318u")

