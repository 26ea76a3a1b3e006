"""Hourly and daily rollups of the fact table.

A bucket is kept as mergeable state (counts, sums, extremes). Daily buckets
can therefore be made from hourly state, without a second pass over the facts.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timebuckets import day_of, day_start, hour_ceil, hour_floor, hour_of, moment
from ..schema import ROLLUP_KEYS
from .filters import PARTITION, TIME, last

# Sums of whole numbers; a sum past these digits is null, and stays so when it is merged.
EXACT = T.DecimalType(38, 0)

STATE = {
    "reading_count": T.LongType(),
    "radiation_sum": T.DoubleType(),
    "radiation_n": T.LongType(),
    "max_radiation": T.DoubleType(),
    "min_radiation": T.DoubleType(),
    "temp_sum": T.DoubleType(),
    "temp_n": T.LongType(),
    "max_temp": T.DoubleType(),
    "min_temp": T.DoubleType(),
    # Moments of the positive counts, for means and deviations of any set of buckets.
    "positive_n": T.LongType(),
    "positive_sum": EXACT,
    "positive_squares": EXACT,
    "first_at": T.TimestampNTZType(),
    "last_at": T.TimestampNTZType(),
}
MOMENTS = ("positive_sum", "positive_squares")


def state_columns() -> list[Column]:
    """The aggregates that make state of facts."""
    radiation = F.col("lnd_7318u").cast("double")
    temp = F.col("env_temp").cast("double")
    positive = F.when(F.col("lnd_7318u") > 0, F.col("lnd_7318u").cast("decimal(19,0)"))
    made = (
        F.count(F.lit(1)),
        F.sum(radiation),
        F.count(radiation),
        F.max(radiation),
        F.min(radiation),
        F.sum(temp),
        F.count(temp),
        F.max(temp),
        F.min(temp),
        F.count(positive),
        F.coalesce(F.try_sum(positive.cast(EXACT)), _none_yet(F.count(positive))),
        F.coalesce(F.try_sum((positive * positive).cast(EXACT)), _none_yet(F.count(positive))),
        F.min(TIME),
        F.max(TIME),
    )
    return [column.alias(name) for name, column in zip(STATE, made)]


def _none_yet(count: Column) -> Column:
    """0 where nothing was added up; null where a sum was too large."""
    return F.when(count == 0, F.lit(0).cast(EXACT))


def bucket_state(facts: DataFrame, bucket: Column, name: str, keys=ROLLUP_KEYS) -> DataFrame:
    """Mergeable state per bucket and identity."""
    return facts.groupBy(bucket.alias(name), *keys).agg(*state_columns())


def merge_state(state: DataFrame, bucket: Column, name: str, keys=ROLLUP_KEYS) -> DataFrame:
    """State of equal or wider buckets from state of narrower ones, or of several parts."""
    sums = ("reading_count", "radiation_sum", "radiation_n", "temp_sum", "temp_n", "positive_n")
    merged = [F.sum(c).alias(c) for c in sums]
    merged += [whole_sum(c).alias(c) for c in MOMENTS]
    merged += [F.max(c).alias(c) for c in ("max_radiation", "max_temp", "last_at")]
    merged += [F.min(c).alias(c) for c in ("min_radiation", "min_temp", "first_at")]
    return state.groupBy(bucket.alias(name), *keys).agg(*merged).select(name, *keys, *STATE)


def whole_sum(name: str) -> Column:
    """A sum of exact parts; null if one of them, or the sum, is too large."""
    return F.when(F.count(name) == F.count(F.lit(1)), F.try_sum(name))


def radiation_moments(state: DataFrame, *keys: str) -> DataFrame:
    """Mean and sample deviation of the positive counts by ``keys``, from state of any buckets.

    Equal to a pass over the facts of those buckets. The deviation's numerator is computed
    in whole numbers where they fit into 38 digits, so constant readings have exactly none.
    """
    n = F.col("n").cast("decimal(20,0)")
    total = state.groupBy(*keys).agg(
        F.sum("positive_n").alias("n"), whole_sum("positive_sum").alias("s"), whole_sum("positive_squares").alias("q")
    )
    exact = F.expr("try_subtract(try_multiply(cast(n as decimal(38,0)), q), try_multiply(s, s))").cast("double")
    rough = F.col("n") * F.col("q").cast("double") - F.col("s").cast("double") * F.col("s").cast("double")
    found = F.coalesce(exact, rough)
    spread = F.when(found < 0, 0.0).otherwise(found)
    pairs = F.col("n").cast("double") * (F.col("n") - 1)
    return total.where("n > 0").select(
        *keys,
        F.try_divide(F.col("s").cast("double"), n.cast("double")).alias("avg_radiation"),
        F.sqrt(F.try_divide(spread, pairs)).alias("stddev_radiation"),
    )


def summary(state: DataFrame, name: str, keys=ROLLUP_KEYS) -> DataFrame:
    """The published columns of a rollup."""
    return state.select(
        name,
        *keys,
        "reading_count",
        F.try_divide("radiation_sum", "radiation_n").alias("avg_radiation"),
        "max_radiation",
        "min_radiation",
        F.try_divide("temp_sum", "temp_n").alias("avg_temp"),
        "max_temp",
        "min_temp",
    )


def hourly_summary(
    facts: DataFrame,
    as_of: datetime,
    days: int = 30,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Hourly rollup of the last ``days``.

    ``since`` and ``until`` keep only buckets that start in that range. They
    are applied to the facts' own time, so the scan skips the other hours.
    """
    kept = last(facts, as_of, days=days)
    if since is not None:
        kept = kept.filter(F.col(TIME) >= moment(hour_ceil(since)))
    if until is not None:
        kept = kept.filter(F.col(TIME) < moment(hour_floor(until) + timedelta(hours=1)))
    return summary(bucket_state(kept, hour_of(TIME), "hour"), "hour")


def daily_summary(
    facts: DataFrame, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Daily rollup of all history, or of the days in a range."""
    if since is not None:
        start = since if since == _midnight(since) else _midnight(since) + timedelta(days=1)
        facts = facts.filter(F.col(TIME) >= moment(start))
    if until is not None:
        facts = facts.filter(F.col(TIME) < moment(_midnight(until) + timedelta(days=1)))
    return summary(bucket_state(facts, day_of(TIME), "day"), "day")


def _midnight(value: datetime) -> datetime:
    return value.replace(hour=0, minute=0, second=0, microsecond=0)


def daily_from_hourly(hourly_state: DataFrame) -> DataFrame:
    """Daily state from hourly state; equal to a pass over the facts."""
    return merge_state(hourly_state, day_of("hour"), "day")


def recent_data(facts: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return last(facts, as_of, days=days)


def refreshed(rollup: DataFrame, recomputed: DataFrame, bucket: str, touched: DataFrame) -> DataFrame:
    """A rollup with the touched buckets exchanged for their recomputed rows."""
    return rollup.join(touched, bucket, "left_anti").unionByName(recomputed)


def touched_buckets(rows: DataFrame, bucket: Column, name: str) -> DataFrame:
    """The distinct time buckets of some rows."""
    return rows.select(bucket.alias(name)).distinct()


def in_buckets(facts: DataFrame, touched: DataFrame, bucket: Column, name: str) -> DataFrame:
    """Facts of the touched buckets. The bucket is computed beside the facts' own
    columns, so that a table's partitions can still be pruned."""
    wanted = touched.withColumnRenamed(name, "_touched")
    return facts.join(wanted, bucket == F.col("_touched"), "left_semi")


def on_days_of(facts: DataFrame, new: DataFrame) -> DataFrame:
    """Facts of the calendar days that ``new`` touches.

    On a table partitioned by ``day`` the days become literals, a few for a
    feed, and only their partitions are read.
    """
    if PARTITION not in facts.columns:
        return facts
    days = [r[0] for r in new.select(day_of(TIME)).distinct().collect() if r[0] is not None]
    return facts.filter(F.col(PARTITION).isin(days))


def hourly_incremental(
    held: DataFrame, facts: DataFrame, new: DataFrame, as_of: datetime, days: int = 30
) -> DataFrame:
    """Exchange every hour that got a new row, however old it is."""
    recent = last(new, as_of, days=days)
    touched = touched_buckets(recent, hour_of(TIME), "hour")
    rows = on_days_of(last(facts, as_of, days=days), recent)
    affected = in_buckets(rows, touched, hour_of(TIME), "hour")
    recomputed = summary(bucket_state(affected, hour_of(TIME), "hour"), "hour")
    return refreshed(held, recomputed, "hour", touched)


def daily_incremental(held: DataFrame, facts: DataFrame, new: DataFrame) -> DataFrame:
    """Exchange every day that got a new row."""
    touched = touched_buckets(new, day_of(TIME), "day")
    affected = in_buckets(on_days_of(facts, new), touched, day_of(TIME), "day")
    recomputed = summary(bucket_state(affected, day_of(TIME), "day"), "day")
    return refreshed(held, recomputed, "day", touched)


def time_stats(
    facts: DataFrame, bucket: Column, name: str, as_of: datetime, days: int
) -> DataFrame:
    """Count, mean and extremes per bucket, device and country."""
    radiation = F.col("lnd_7318u").cast("double")
    return (
        last(facts, as_of, days=days)
        .groupBy(bucket.alias(name), "device_urn", "loc_country")
        .agg(
            F.count(F.lit(1)).alias("reading_count"),
            F.avg(radiation).alias("avg_radiation"),
            F.max(radiation).alias("max_radiation"),
            F.min(radiation).alias("min_radiation"),
        )
    )


def hourly_stats(facts: DataFrame, as_of: datetime) -> DataFrame:
    return time_stats(facts, hour_of(TIME), "hour", as_of, 30)


def daily_stats(facts: DataFrame, as_of: datetime) -> DataFrame:
    return time_stats(facts, day_start(TIME), "day", as_of, 90)
