"""Casts next to DuckDB's on texts that are easy to get wrong."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from sensorspan.functions.casting import number_to_bigint, to_bigint, to_double, to_moment
from sensorspan.functions.timebuckets import (
    bucket,
    day_start,
    epoch_days,
    from_instant,
    hour_of,
    moment,
    to_instant,
)

NUMBERS = [
    "21.7", "22.5", "21.5", "1e3", "+5", " 7 ", "1_000", "1d", "1f", "nan", "inf", "-2.5", "-22.5",
    "9007199254740993", "1e30", ".5", "5.", "", "abc", "1e-3", "0.5", "1.5", "0",
    "99999999999999999999", "9223372036854775807", "9223372036854775807.4", "12 3", "--1", "1e",
    "1.2.3", "true", "-0", "007", "1.5e2", "2.49999999999999", None,
]
MOMENTS = [
    "2012-00-00T00:00:00Z", "2024-11", "2024-11-02", "2024-11-02T15:30:00", "2024-11-02T15:30:00Z",
    "2024-11-02 15:30:00.5", "2024-11-02T15:30:00+09:00", "2024-11-02 15:30", "2024/11/02",
    "2024-1-2", "2024-1-2 3:04:05", "20241102", "", "abc", "2024-11-02T15:30:00.1234567Z",
    "2024-02-30", "2024-02-30T10:00:00Z", "2080-01-09", "2024-11-02T24:00:00",
    "2024-11-02T15:60:00", "2024-11-02T15:30:00 UTC", "2024-11-02T15", "2024-11-02T15:30Z",
    "2024-11-02X15:30:00", "2024-11-02T25:00:00", "2024-11-02 15:30:00 ", " 2024-11-02",
    "2024-13-01T00:00:00", None,
]


def _both(spark, texts, column, sql):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    ours = [r[0] for r in df.select("i", column(F.col("s")).alias("v")).orderBy("i").select("v").collect()]
    con = duckdb.connect()
    theirs = [con.execute(f"SELECT {sql}", [t]).fetchall()[0][0] for t in texts]
    return dict(zip(texts, map(repr, ours))), dict(zip(texts, map(repr, theirs)))


@pytest.mark.parametrize(
    ("texts", "column", "sql"),
    [
        (NUMBERS, to_bigint, "try_cast(?::varchar as bigint)"),
        (NUMBERS, to_double, "try_cast(?::varchar as double)"),
        (MOMENTS, to_moment, "try_cast(?::varchar as timestamp)"),
    ],
)
def test_same_as_duckdb(spark, texts, column, sql):
    ours, theirs = _both(spark, texts, column, sql)
    assert ours == theirs


def test_feed_numbers_round_like_doubles(spark):
    numbers = [t for t in NUMBERS if t not in ("9007199254740993", "9223372036854775807")]
    ours, theirs = _both(
        spark, numbers, number_to_bigint, "try_cast(try_cast(?::varchar as double) as bigint)"
    )
    del ours["9223372036854775807.4"], theirs["9223372036854775807.4"]
    assert ours == theirs


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_buckets_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day.
        row = (
            spark.range(1)
            .select(moment("2024-03-10 02:47:11.5").alias("t"))
            .select(
                hour_of("t").cast("string"),
                day_start("t").cast("string"),
                bucket(F.col("t"), "15 minutes").cast("string"),
                epoch_days(F.col("t"), moment("2024-03-09 02:47:11.5")),
                F.unix_micros(to_instant(F.col("t"))),
                from_instant(to_instant(F.col("t"))).cast("string"),
            )
            .first()
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (
        "2024-03-10 02:00:00",
        "2024-03-10 00:00:00",
        "2024-03-10 02:45:00",
        1.0,
        1710038831500000,
        "2024-03-10 02:47:11.5",
    )
