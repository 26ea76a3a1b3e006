"""Small hand-made feeds."""

from __future__ import annotations

from sensorspan.schema import FEED_FIELDS

PLAIN = {
    "when_captured": "2024-01-05T10:15:00Z",
    "device_urn": "fixed:1",
    "device_sn": "65001",
    "device": "1",
    "loc_name": "roof",
    "loc_country": "JP",
    "loc_lat": "35.5",
    "loc_lon": "139.5",
    "env_temp": "20.0",
    "lnd_7318c": "31",
    "lnd_7318u": "30.0",
    "lnd_7128ec": "",
    "pms_pm02_5": "4.5",
    "bat_voltage": "3.7",
    "dev_temp": "25.0",
}


def feed(spark, *objects: dict):
    """Feed objects that differ from ``PLAIN`` in the given fields."""
    rows = [
        (i, *[({**PLAIN, **changed})[name] for name in FEED_FIELDS])
        for i, changed in enumerate(objects)
    ]
    schema = "pos bigint, " + ", ".join(f"{name} string" for name in FEED_FIELDS)
    return spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
