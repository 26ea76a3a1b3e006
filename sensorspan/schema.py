"""Schemas of the feed, the fact table and the rollups."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the device feed, in feed order.
FEED_FIELDS = (
    "when_captured",
    "device_urn",
    "device_sn",
    "device",
    "loc_name",
    "loc_country",
    "loc_lat",
    "loc_lon",
    "env_temp",
    "lnd_7318c",
    "lnd_7318u",
    "lnd_7128ec",
    "pms_pm02_5",
    "bat_voltage",
    "dev_temp",
)

# The fact table's columns and types.
MEASUREMENTS = T.StructType(
    [
        T.StructField("bat_voltage", T.StringType()),
        T.StructField("dev_temp", T.LongType()),
        T.StructField("device", T.LongType()),
        T.StructField("device_sn", T.StringType()),
        T.StructField("device_urn", T.StringType()),
        T.StructField("device_filename", T.StringType()),
        T.StructField("env_temp", T.LongType()),
        T.StructField("lnd_7128ec", T.StringType()),
        T.StructField("lnd_7318c", T.StringType()),
        T.StructField("lnd_7318u", T.LongType()),
        T.StructField("loc_country", T.StringType()),
        T.StructField("loc_lat", T.DoubleType()),
        T.StructField("loc_lon", T.DoubleType()),
        T.StructField("loc_name", T.StringType()),
        T.StructField("pms_pm02_5", T.StringType()),
        T.StructField("when_captured", T.TimestampNTZType()),
    ]
)
MEASUREMENT_COLUMNS = tuple(MEASUREMENTS.names)

# One reading per device and moment.
FACT_KEY = ("device", "when_captured")
# What makes two raw feed objects the same reading.
FEED_KEY = ("device_urn", "when_captured")

# The rollups' identity columns beside the time bucket.
ROLLUP_KEYS = ("device_urn", "device_sn", "loc_country", "loc_name", "loc_lat", "loc_lon")
ROLLUP_MEASURES = (
    "reading_count",
    "avg_radiation",
    "max_radiation",
    "min_radiation",
    "avg_temp",
    "max_temp",
    "min_temp",
)

# Every feed value is read as text: devices send numbers and strings for the
# same field, and typing happens once, in ``functions.casting``.
FEED = T.StructType([T.StructField(name, T.StringType()) for name in FEED_FIELDS])

# The older point format, without a time of its own.
LEGACY_POINT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("longitude", "latitude", "device_id", "value", "unit", "height")
    ]
)

# The older wide format: the feed's fields and a device class.
LEGACY_WIDE = T.StructType([*FEED.fields, T.StructField("device_class", T.StringType())])

CORRUPT = "_corrupt_record"
