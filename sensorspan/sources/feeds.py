"""Device feeds as DataFrames of text fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CORRUPT, FEED, FEED_FIELDS


def scan_json_array(spark: SparkSession, path: str, schema: T.StructType = FEED) -> DataFrame:
    """Files that each hold one JSON array of objects, one row per object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def scan_ndjson(spark: SparkSession, path: str, schema: T.StructType = FEED) -> DataFrame:
    """One object per line; files are split between tasks."""
    return spark.read.schema(schema).json(path)


def scan_tolerant(spark: SparkSession, path: str, schema: T.StructType = FEED) -> DataFrame:
    """``scan_ndjson`` without the lines that do not parse."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def scan_audited(spark: SparkSession, path: str, schema: T.StructType = FEED) -> DataFrame:
    """``scan_ndjson`` with the text of lines that do not parse in a column."""
    audited = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(audited)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def explode_feed(
    df: DataFrame, body: Column | str, schema: T.StructType = FEED, *carry: str
) -> DataFrame:
    """A column of JSON arrays to rows, with each object's place as ``pos``."""
    objects = F.from_json(body, T.ArrayType(schema))
    return df.select(*carry, F.posexplode(objects).alias("pos", "object")).select(
        *carry, "pos", "object.*"
    )


def template_projection(df: DataFrame) -> DataFrame:
    """The named feed fields only; the reader parses nothing else."""
    return df.select(*FEED_FIELDS)


def from_legacy_points(points: DataFrame) -> DataFrame:
    """Old point rows in the feed's fields. The unit tells the sensor."""
    cpm = F.lower("unit") == "cpm"
    pm25 = F.lower("unit").isin("pm2.5", "pm02_5", "ug/m3")
    named = points.select(
        F.col("device_id").alias("device"),
        F.col("latitude").alias("loc_lat"),
        F.col("longitude").alias("loc_lon"),
        F.when(cpm, F.col("value")).alias("lnd_7318u"),
        F.when(pm25, F.col("value")).alias("pms_pm02_5"),
    )
    missing = [name for name in FEED_FIELDS if name not in named.columns]
    return named.select(
        *[F.lit(None).cast("string").alias(n) if n in missing else F.col(n) for n in FEED_FIELDS]
    )


def normalise_legacy(points: DataFrame | None, wide: DataFrame | None) -> DataFrame:
    """Old point rows and old wide rows as one feed."""
    parts = []
    if points is not None:
        parts.append(from_legacy_points(points))
    if wide is not None:
        parts.append(template_projection(wide))
    feed = parts[0]
    for part in parts[1:]:
        feed = feed.unionByName(part)
    return feed


