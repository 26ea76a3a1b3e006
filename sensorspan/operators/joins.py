"""Joins of the fact table with small derived relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_device_stats(facts: DataFrame, stats: DataFrame) -> DataFrame:
    """Facts with their device's statistics; ``stats`` has one row per device.

    There is no hint: the planner broadcasts ``stats`` while its measured size
    allows it, and otherwise splits the facts of a device that has too many.
    """
    return facts.join(stats, "device_urn")


def device_radiation_stats(facts: DataFrame) -> DataFrame:
    """Mean and sample deviation of each device's positive radiation counts."""
    return (
        facts.filter(F.col("lnd_7318u") > 0)
        .groupBy("device_urn")
        .agg(
            F.avg("lnd_7318u").alias("avg_radiation"),
            F.stddev_samp("lnd_7318u").alias("stddev_radiation"),
        )
    )
