"""Newest reading per device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timebuckets import moment
from .dedupe import newest_per_key

LATEST_COLUMNS = ("device_urn", "device_sn", "loc_country", "loc_name", "loc_lat", "loc_lon")

# The columns of a newest reading.
LATEST_ROW = ("device_urn", "last_reading", *LATEST_COLUMNS[1:], "radiation")


def latest_order(columns: Sequence[str]) -> list[str]:
    """What makes one of a device's readings the newest: its time, then the other columns."""
    return ["last_reading", *[c for c in columns if c not in ("device_urn", "last_reading")]]


def latest_rows(facts: DataFrame) -> DataFrame:
    """The columns of a newest reading, of all readings."""
    return facts.select(
        *LATEST_COLUMNS,
        F.col("lnd_7318u").alias("radiation"),
        F.col("when_captured").alias("last_reading"),
    )


def latest_by_device(facts: DataFrame) -> DataFrame:
    """One row per device: where it is and what it last read.

    Equal times are settled by the remaining columns, so the row is the same
    on every run.
    """
    rows = latest_rows(facts)
    # The newest time is a plain maximum; only rows at that time are compared whole.
    newest = rows.groupBy("device_urn").agg(F.max("last_reading").alias("last_reading"))
    ends = rows.join(newest, ["device_urn", "last_reading"], "left_semi")
    return newest_per_key(ends, ["device_urn"], latest_order(rows.columns))


def map_latest_positions(hourly: DataFrame, since) -> DataFrame:
    """Each device's newest hour for the map; two positions in one hour are
    settled by latitude, then longitude."""
    rows = hourly.filter(F.col("hour") >= moment(since)).select(
        "device_urn",
        F.col("loc_lat").alias("latitude"),
        F.col("loc_lon").alias("longitude"),
        F.col("avg_radiation").alias("value"),
        F.col("hour").alias("time"),
        "loc_country",
    )
    order = ["time", "latitude", "longitude", "loc_country", "value"]
    return newest_per_key(rows, ["device_urn"], order)
