"""The tables and their standing views by name, for queries written in SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.latest import latest_by_device
from ..operators.rollups import (
    daily_stats,
    daily_summary,
    hourly_stats,
    hourly_summary,
    recent_data,
)


def standing_views(
    facts: DataFrame,
    as_of: datetime,
    hourly: DataFrame | None = None,
    daily: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Views over the facts; stored rollups take the place of computed ones."""
    return {
        "measurements": facts,
        "hourly_summary": hourly_summary(facts, as_of) if hourly is None else hourly,
        "daily_summary": daily_summary(facts) if daily is None else daily,
        "recent_data": recent_data(facts, as_of),
        "recent_measurements": recent_data(facts, as_of),
        "hourly_stats": hourly_stats(facts, as_of),
        "daily_stats": daily_stats(facts, as_of),
        "latest_by_device": latest_by_device(facts),
    }


def register_views(views: dict[str, DataFrame], prefix: str = "") -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)


def run_sql(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    """A query over the registered views; ``:name`` marks a parameter."""
    return spark.sql(text, args=parameters)
