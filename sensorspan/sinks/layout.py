"""Data layout in place of secondary indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timebuckets import day_of, year_of
from ..operators.filters import TIME


# The columns that dashboards filter by, and the rows that borders between their ranges come from.
ACCESS = ("day", "device_urn", "loc_country")
SAMPLE = 20_000


def write_clustered(df: DataFrame, path: str) -> None:
    """Partitioned by day and ordered by device and time inside a day.

    Range partitioning includes the time, so a device with very many readings
    is cut by time. Row groups then have narrow device and time ranges, which
    lets the scan skip most of them.
    """
    order = ["day", "device_urn", TIME]
    (
        df.withColumn("day", day_of(TIME))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("day")
        .parquet(path)
    )


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """A number that rows near each other in all of ``columns`` have near each other.

    Each column is cut into 2**bits ranges of about equal counts, whose borders come from
    a sample of about ``SAMPLE`` rows, and the bits of the ranges' numbers take turns (a Z-order curve).
    """
    rows = df.select(*columns)
    sample = rows.sample(min(1.0, SAMPLE / max(rows.count(), 1)), seed=1).limit(2 * SAMPLE).toArrow()
    ranks = []
    for name in columns:
        values = sorted(v for v in sample.column(name).to_pylist() if v is not None)
        at = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        edges = F.array(*(F.lit(v) for v in dict.fromkeys(at))) if at else F.array(F.lit(None).cast(df.schema[name].dataType))
        ranks.append(F.coalesce(F.size(F.filter(edges, lambda edge: edge <= F.col(name))), F.lit(0)))
    place = F.lit(0)
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            place = place + F.shiftleft(one, bit * len(ranks) + i)
    return place


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str] = ACCESS, files: int | None = None) -> None:
    """Files that each hold a narrow range of every one of ``columns``.

    A filter on any of them, or on several, skips most files, where an order by one
    column serves that column only. The files are about equally large.
    """
    placed = df.withColumn("day", day_of(TIME))
    placed = placed.withColumn("_place", interleaved(placed, columns))
    order = ["_place", *columns, TIME]
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).drop("_place").write.mode("overwrite").parquet(path)


def write_by_year(df: DataFrame, path: str) -> None:
    """Partitioned by year; rebalancing evens out the years' files."""
    (
        df.withColumn("year", year_of(TIME))
        .hint("rebalance", "year")
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(path)
    )


def scan_year(df: DataFrame, year: int) -> DataFrame:
    """One year; only its partition is read."""
    return df.filter(F.col("year") == year).drop("year")
