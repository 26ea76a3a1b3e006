"""Defaults and derived fields of a feed object."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a missing field is stored as.
MISSING_TEXT = "0"
MISSING_NUMBER = "0"
UNKNOWN_FILE = "unknown_device.json"


def fill_timestamp(text: Column, batch_time: datetime | Column) -> Column:
    """No time of its own: the time of the batch, to the second."""
    if isinstance(batch_time, Column):
        stamp = F.date_format(batch_time, "yyyy-MM-dd HH:mm:ss")
    else:
        stamp = F.lit(batch_time.strftime("%Y-%m-%d %H:%M:%S"))
    return F.when(text.isNull() | (text == ""), stamp).otherwise(text)


def default_string(text: Column) -> Column:
    """A missing string becomes ``"0"``; an empty one is a value and stays."""
    return F.coalesce(text, F.lit(MISSING_TEXT))


def default_number(text: Column) -> Column:
    """A missing or empty number becomes 0."""
    return F.when(text.isNull() | (text == ""), F.lit(MISSING_NUMBER)).otherwise(text)


def derive_filename(urn: Column) -> Column:
    """The name of the file that holds a device's readings."""
    known = urn.isNotNull() & ~urn.isin("", MISSING_TEXT)
    name = F.concat(F.regexp_replace(urn, '[:"]', "_"), F.lit(".json"))
    return F.when(known, name).otherwise(F.lit(UNKNOWN_FILE))


def safe_name(urn: Column) -> Column:
    """A device name that can stand in a path."""
    return F.translate(urn, ":", "_")
