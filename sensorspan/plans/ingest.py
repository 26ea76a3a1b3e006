"""From a raw feed to typed fact rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import number_to_bigint, to_bigint, to_double, to_moment
from ..functions.cleaning import (
    UNKNOWN_FILE,
    default_number,
    default_string,
    derive_filename,
    fill_timestamp,
)
from ..operators.dedupe import unique_by_first
from ..schema import FEED_KEY, MEASUREMENT_COLUMNS


def clean_feed(feed: DataFrame, batch_time: datetime | Column, *keep: str) -> DataFrame:
    """Defaults for missing fields and the derived file name, all as text.

    Columns named in ``keep`` are carried along unchanged.
    """
    c = F.col
    text = ("device_urn", "device_sn", "device", "loc_name", "loc_country")
    sensors = ("lnd_7318c", "lnd_7128ec", "pms_pm02_5")
    numbers = ("loc_lat", "loc_lon", "env_temp", "lnd_7318u", "bat_voltage", "dev_temp")
    return feed.select(
        fill_timestamp(c("when_captured"), batch_time).alias("when_captured"),
        *[default_string(c(name)).alias(name) for name in text + sensors],
        *[default_number(c(name)).alias(name) for name in numbers],
        derive_filename(c("device_urn")).alias("device_filename"),
        *keep,
    )


def enforce_schema(cleaned: DataFrame, *keep: str) -> DataFrame:
    """The fact table's types; a value that does not parse becomes NULL."""
    c = F.col
    typed = {
        "dev_temp": number_to_bigint(c("dev_temp")),
        "device": to_bigint(c("device")),
        "device_filename": F.coalesce(c("device_filename"), F.lit(UNKNOWN_FILE)),
        "env_temp": number_to_bigint(c("env_temp")),
        "lnd_7318u": number_to_bigint(c("lnd_7318u")),
        "loc_lat": to_double(c("loc_lat")),
        "loc_lon": to_double(c("loc_lon")),
        "when_captured": to_moment(c("when_captured")),
    }
    return cleaned.select(*[typed.get(n, c(n)).alias(n) for n in MEASUREMENT_COLUMNS], *keep)


def valid_time(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("when_captured").isNotNull())


def ingest(feed: DataFrame, batch_time: datetime, position: str = "pos") -> DataFrame:
    """Dedupe on the raw values, clean, type, drop rows without a time.

    ``position`` is the objects' place in the feed. It stays on the rows as the
    order in which later steps let the first one win: by raw device, by raw
    time, then by that place, whatever the device's number is.
    """
    first = unique_by_first(feed, position)
    place = F.struct(*FEED_KEY, F.col(position).alias("place"))
    rows = first.withColumn(position, place)
    return valid_time(enforce_schema(clean_feed(rows, batch_time, position), position))
