"""File exports. Each is one distributed write of the given rows."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import materialise, scratch_path
from ..functions.casting import to_double
from ..functions.cleaning import safe_name
from ..operators.dedupe import merge_history, without
from ..operators.filters import last
from ..schema import FEED_KEY
from ..tables.slots import SLOT, Slots

# The sensor feeds' names and the column each one reads.
SENSOR_FEEDS = (
    ("air", "pms_pm02_5"),
    ("radiation-7128ec", "lnd_7128ec"),
    ("radiation-7318u", "lnd_7318u"),
    ("radiation-7318c", "lnd_7318c"),
)
ALL_DEVICES = "all"

# Buckets of devices that an export of single devices is rewritten by.
EXPORT_BUCKETS = 64

# So many files of devices are listed or written at once; the driver holds a few kilobytes for each of them.
FILES_AT_ONCE = 20_000


# Writers cut zone-less times to milliseconds unless told otherwise.
MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**MICROS).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**MICROS).option("header", False).csv(path)


def _bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one JSON array from the JSON objects of a partition: `[` alone, each object
    with a comma before it but the first, `]` alone."""
    yield pa.RecordBatch.from_arrays([pa.array(["["])], ["value"])
    opened = False
    for batch in batches:
        lines = batch.column(0).cast(pa.string())
        if not opened and len(lines):
            yield pa.RecordBatch.from_arrays([lines.slice(0, 1)], ["value"])
            lines, opened = lines.slice(1), True
        if len(lines):
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise("", lines, ",")], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])


def write_json_array(df: DataFrame, path: str) -> None:
    """JSON arrays for readers that take no line-delimited files.

    Every part file is one whole array of its partition's rows, `[` and `]` if
    it has none; a result without partitions is written as one empty array. A
    dashboard that takes a single array reads a single file, so a result
    meant for it, a few panel rows, is coalesced by its caller. Only brackets
    and commas are added in Python, batch by batch; no partition is held in memory.
    """
    objects = df.select(F.to_json(F.struct("*"), MICROS).alias("value"))
    if objects.isEmpty():
        objects = objects.sparkSession.range(1, numPartitions=1).select(F.lit("").alias("value")).where("value <> ''")
    objects.mapInArrow(_bracketed, "value string").write.mode("overwrite").text(path)


def write_per_device(df: DataFrame, path: str) -> None:
    """One folder per device, newest readings first.

    Range partitions on device and time: a device with very many rows is cut
    into several files, whose names keep the order.
    """
    named = df.withColumn("device_file", safe_name(F.col("device_urn")))
    order = [F.col("device_file"), F.col("when_captured").desc()]
    (
        named.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .options(**MICROS)
        .partitionBy("device_file")
        .json(path)
    )


def per_device_history(held: DataFrame, incoming: DataFrame) -> DataFrame:
    """What the per-device files hold next: what they held, then what is new."""
    order = [name for name in held.columns if name not in ("device_urn", "when_captured")]
    known = incoming.filter(F.col("device_urn").isNotNull() & (F.col("device_urn") != ""))
    return merge_history(held, known, order)


def _device_slots(spark: SparkSession, path: str, schema: T.StructType) -> Slots:
    """The exported histories, in hash buckets of devices and a folder for each device."""
    order = [F.col(SLOT), F.col("device_file"), F.col("when_captured").desc()]
    return Slots(
        spark,
        path,
        schema,
        kind="json",
        options=MICROS,
        inner=("device_file",),
        arrange=lambda rows: rows.repartitionByRange(*order).sortWithinPartitions(*order),
    )


def _device_slot(file: Column) -> Column:
    return F.pmod(F.xxhash64(file), F.lit(EXPORT_BUCKETS)).cast("string")


def _in_steps(files: dict[str, int]) -> list[set[str]]:
    """Buckets, with their numbers of files, in groups of no more than ``FILES_AT_ONCE`` files or of one bucket."""
    steps: list[set[str]] = []
    left = 0
    for slot, n in sorted(files.items()):
        if not steps or n > left:
            steps.append(set())
            left = FILES_AT_ONCE
        steps[-1].add(slot)
        left -= n
    return steps


def held_per_device(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """What the exported files hold; None before the first export.

    A reader lists all of its files on the driver. Many files are read in steps, whose rows are written into few files.
    """
    table = _device_slots(spark, path, schema)
    if not table.versions():
        return None
    steps = _in_steps(table.folders())
    if len(steps) < 2:
        return table.read()
    rows = materialise(table.read(slots=steps[0]), "exported")
    for step in steps[1:]:
        rows = rows.unionByName(materialise(table.read(slots=step), "exported"))
    return rows


def device_folder(spark: SparkSession, path: str, device_urn: str) -> str:
    """The folder with a device's newest exported files; it exists if the device has readings."""
    file = safe_name(F.lit(device_urn))
    name, slot = spark.range(1).select(file, _device_slot(file)).first()
    return f"{_device_slots(spark, path, T.StructType()).folder(slot)}/device_file={name}"


def update_per_device(incoming: DataFrame, path: str) -> None:
    """Add new readings to the exported files, again and again.

    Only the buckets of devices that have sent something are read, and of them only those with a reading that is
    not held are merged and written, beside their old files, which stay until the next but one export of the bucket.
    Many files are written in steps of some buckets, which are seen together at the end. An export that dies leaves
    the files as they were.
    """
    spark = incoming.sparkSession
    named = T.StructType([*incoming.schema.fields, T.StructField("device_file", T.StringType())])
    table = _device_slots(spark, path, named)
    known = incoming.filter(F.col("device_urn").isNotNull() & (F.col("device_urn") != ""))

    def filed(rows: DataFrame) -> DataFrame:
        file = safe_name(F.col("device_urn"))
        return rows.withColumn("device_file", file).withColumn(SLOT, _device_slot(file))

    def merge(held: DataFrame, changed: DataFrame) -> DataFrame:
        columns = incoming.columns
        return filed(per_device_history(held.select(*columns), changed.select(*columns)))

    new = filed(known)
    version = max(table.versions(), default=0) + 1
    files = {row[0]: row[1] for row in new.groupBy(SLOT).agg(F.count_distinct("device_file")).collect()}
    held = table.folders(files.keys())
    table.discard(version)
    touched: set[str] = set()
    steps = _in_steps({slot: max(n, held.get(slot, 0)) for slot, n in files.items()})
    if len(steps) > 1:  # computed once; a step reads its buckets
        staged = scratch_path(spark, "incoming")
        new.hint("rebalance", SLOT).write.partitionBy(SLOT).parquet(staged)
        new = spark.read.schema(new.schema).parquet(staged)
    for step in steps:
        added = new.where(F.col(SLOT).isin(sorted(step)))
        if held.keys() & step:
            added = without(added, table.read(slots=step), FEED_KEY)
        touched |= table.merge(version, added, merge, publish=False)
    table.publish(version, touched)


def sensor_feeds(df: DataFrame, as_of: datetime) -> DataFrame:
    """The last 24 hours, once per feed a row belongs to, in one pass.

    All rows go to the feed of all devices; a sensor's feed takes the rows
    with a positive reading of it.
    """
    day = last(df, as_of, hours=24)
    member = [
        F.when(to_double(F.col(column).cast("string")) > 0, F.lit(name))
        for name, column in SENSOR_FEEDS
    ]
    feeds = F.array_compact(F.array(F.lit(ALL_DEVICES), *member))
    return day.withColumn("sensor", F.explode(feeds))


def write_sensor_feeds(df: DataFrame, as_of: datetime, path: str) -> None:
    rows = sensor_feeds(df, as_of)
    rows.write.mode("overwrite").options(**MICROS).partitionBy("sensor").json(path)
