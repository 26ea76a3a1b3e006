"""Statistics expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the mean in deviations; NULL where there is no spread."""
    return F.try_divide(value - mean, deviation)


def sync_message(rows: Column) -> Column:
    return F.concat(F.lit("Synced "), rows.cast("string"), F.lit(" new measurements"))
