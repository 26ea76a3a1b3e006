"""One row for each device, kept up to date by merging what each load adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MEASUREMENTS
from .latest import LATEST_COLUMNS, latest_by_device, latest_order
from .rollups import EXACT, MOMENTS, STATE, state_columns, whole_sum

BUCKETS = 16
SLOT = "slot"

_NEWEST = [
    *(MEASUREMENTS[c] for c in LATEST_COLUMNS),
    T.StructField("radiation", T.LongType()),
    T.StructField("last_reading", T.TimestampNTZType()),
]
NEWEST = T.StructType(_NEWEST)
# The newest reading, the first time, the number of readings, moments of the positive counts,
# and a number that the device keeps.
DEVICES = T.StructType(
    [
        *_NEWEST,
        T.StructField("first_reading", T.TimestampNTZType()),
        T.StructField("reading_count", T.LongType()),
        T.StructField("positive_n", T.LongType()),
        *(T.StructField(name, EXACT) for name in MOMENTS),
        T.StructField("number", T.LongType()),
    ]
)


def bucket_of(device: Column | str, buckets: int = BUCKETS) -> Column:
    """The hash bucket of a device, as a text."""
    return F.pmod(F.xxhash64(device), F.lit(buckets)).cast("string")


def device_slots(rows: DataFrame) -> DataFrame:
    return rows.withColumn(SLOT, bucket_of("device_urn"))


def device_state(facts: DataFrame) -> DataFrame:
    """The row of each device of some facts. Null devices are one device."""
    counts = [column for column, name in zip(state_columns(), STATE) if name in DEVICES.names]
    totals = facts.groupBy(F.col("device_urn").alias("_device")).agg(F.min("when_captured").alias("first_reading"), *counts)
    newest = latest_by_device(facts)
    joined = newest.join(totals, newest["device_urn"].eqNullSafe(totals["_device"]))
    return joined.withColumn("number", F.lit(None).cast("long")).select(*DEVICES.names)


def device_rows(facts: DataFrame) -> DataFrame:
    """Each fact as the row of a device that has sent nothing else; ``merge_devices`` adds them up."""
    positive = F.col("lnd_7318u") > 0
    value = F.when(positive, F.col("lnd_7318u")).otherwise(0).cast("decimal(19,0)")
    extra = {
        "first_reading": F.col("last_reading"),
        "reading_count": F.lit(1).cast("long"),
        "positive_n": F.coalesce(positive, F.lit(False)).cast("long"),
        "positive_sum": value.cast(EXACT),
        "positive_squares": (value * value).cast(EXACT),
        "number": F.lit(None).cast("long"),
    }
    named = {"radiation": F.col("lnd_7318u"), "last_reading": F.col("when_captured")}
    return facts.withColumns(named).withColumns(extra).select(*DEVICES.names)


def renumbered(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows made anew, with the numbers that their devices have in ``held``; new ones get new numbers."""
    known = held.select(F.col("device_urn").alias("_device"), F.col("number").alias("_number"))
    joined = rows.join(known, rows["device_urn"].eqNullSafe(known["_device"]), "left")
    return _numbered(device_slots(joined.withColumn("number", F.col("_number")).select(*DEVICES.names)))


def merge_devices(held: DataFrame, changed: DataFrame) -> DataFrame:
    """The newest reading of both, their earliest time, and their sums."""
    both = device_slots(held).unionByName(changed)
    rest = [name for name in NEWEST.names if name != "device_urn"]
    newest = F.max_by(F.struct(*rest), F.struct(*latest_order(NEWEST.names))).alias("_newest")
    merged = both.groupBy("device_urn").agg(
        newest,
        F.min("first_reading").alias("first_reading"),
        *(F.sum(c).alias(c) for c in ("reading_count", "positive_n")),
        *(whole_sum(c).alias(c) for c in MOMENTS),
        F.max("number").alias("number"),
    )
    return _numbered(device_slots(merged.select("device_urn", "_newest.*", *DEVICES.names[len(NEWEST.names) :])))


def _numbered(rows: DataFrame) -> DataFrame:
    """New devices of a bucket get the numbers after those that its devices have.

    The devices of bucket b have the numbers b, b + 16, b + 32 and so on, so buckets are numbered alone.
    """
    bucket = Window.partitionBy(SLOT)
    new = F.row_number().over(Window.partitionBy(SLOT, F.col("number").isNull()).orderBy("device_urn")) - 1
    taken = F.coalesce(F.floor(F.max("number").over(bucket) / BUCKETS) + 1, F.lit(0))
    number = F.coalesce("number", F.col(SLOT).cast("long") + BUCKETS * (taken + new))
    return rows.withColumn("number", number.cast("long"))
