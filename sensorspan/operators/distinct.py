"""Distinct devices by time, as state that merges: exact bitmaps, or small sketches.

A bitmap has a bit for each device number, in blocks of 32,768 devices; merging is a
bitwise or, so the devices of any set of buckets are counted without their facts. A sketch is a few
kilobytes whatever it has seen, and counts within a known error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITMAP = T.StructType([T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType())])
# Registers of a sketch, as a power of two: 4,096, for a relative error of 1.6 %.
SKETCH_SIZE = 12


def device_bitmaps(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """The devices of each group of ``rows`` (with their ``number``, from 0), as (keys, block, bits)."""
    at = F.col("number") + 1
    return rows.groupBy(*keys, F.bitmap_bucket_number(at).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def merge_bitmaps(state: DataFrame, *keys: Column | str) -> DataFrame:
    return state.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(state: DataFrame, *keys: str, name: str = "devices") -> DataFrame:
    """The distinct devices of each group of state; one row without ``keys``, also for no state."""
    counted = merge_bitmaps(state, *keys).withColumn("bits", F.bitmap_count("bits"))
    return counted.groupBy(*keys).agg(F.coalesce(F.sum("bits"), F.lit(0)).cast("long").alias(name))


def device_sketches(facts: DataFrame, *keys: Column | str, device: str = "device_urn") -> DataFrame:
    """A sketch of the devices of each group, as (keys, sketch)."""
    return facts.groupBy(*keys).agg(F.hll_sketch_agg(device, F.lit(SKETCH_SIZE)).alias("sketch"))


def merge_sketches(state: DataFrame, *keys: Column | str) -> DataFrame:
    return state.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate_sketches(state: DataFrame, *keys: str, name: str = "devices") -> DataFrame:
    """About how many distinct devices each group of state has."""
    merged = merge_sketches(state, *keys)
    return merged.select(*keys, F.hll_sketch_estimate("sketch").alias(name))
