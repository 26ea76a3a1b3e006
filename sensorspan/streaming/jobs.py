"""Structured Streaming jobs. A landed feed file is the unit of arrival.

Every job brings each micro-batch into published tables. What a batch adds is
decided against all facts held, not against a window of state: a reading that
comes again is no new fact, a late one changes its own hour and day however
old it is, and one without a device or from the future is set aside and
counted, so that no clock error can hold up later rows. Facts are compared
only with those of the same calendar days, which bounds the work of a batch by
what it touches.

Each job takes a checkpoint folder and can be stopped, killed and started
again. A batch is named by the stream that sent it and by its number there, so
that it is brought in once, and several streams and batch loads can share the
tables one after another.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import ingest
from ..schema import CORRUPT, FEED
from ..tables.lake import TelemetryTables

EXACT = "batch_id"
PLACE = "_place"

# The time that stands in for a missing one: fixed, or asked for each batch.
Clock = Callable[[], datetime] | datetime


def _place() -> F.Column:
    """Where an object stands among the files, older files first."""
    parts = ("file_modification_time", "file_path", "file_block_start")
    return F.struct(*(F.col(f"_metadata.{name}") for name in parts))


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType = FEED,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The landing folder as a stream of feed objects and their places.

    A line that does not parse is a row with its text and nothing else.
    """
    audited = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(audited).option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).withColumn(PLACE, _place())


def positioned(batch: DataFrame) -> DataFrame:
    """A feed with its objects' places: file by file by age, then line by line."""
    line = F.monotonically_increasing_id().alias("line")
    if PLACE in batch.columns:
        return batch.withColumn("pos", F.struct(PLACE, line)).drop(PLACE)
    try:
        return batch.withColumn("pos", F.struct(_place().alias(PLACE), line))
    except AnalysisException:  # not read from files
        return batch.withColumn("pos", line)


def now(clock: Clock) -> datetime:
    return clock() if callable(clock) else clock


def source_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint folder belongs to.

    Spark gives a stream its id when the folder is new, so one that starts
    over, with batch numbers from 0, is another source.
    """
    written = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return f"stream:{json.loads(written)['id']}"


def _start(writer, checkpoint: str, continuous: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if continuous:
        return writer.trigger(processingTime=continuous).start()
    return writer.trigger(availableNow=True).start()


def stream_ingest(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    clock: Clock,
    continuous: str | None = None,
) -> StreamingQuery:
    """Dedupe, clean and type each batch by itself.

    Lines that did not parse are kept as text beside ``path``, in ``path-torn``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if CORRUPT in batch.columns:
            torn = batch.filter(F.col(CORRUPT).isNotNull())
            torn.select("device_urn", F.col(CORRUPT).alias("line")).write.mode("overwrite").parquet(f"{path}-torn/{EXACT}={batch_id}")
            batch = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        rows = ingest(positioned(batch), now(clock)).drop("pos")
        rows.write.mode("overwrite").parquet(f"{path}/{EXACT}={batch_id}")

    return _start(feed.writeStream.foreachBatch(write), checkpoint, continuous)


def stream_publish(
    feed: DataFrame,
    root: str,
    checkpoint: str,
    clock: Clock,
    continuous: str | None = None,
) -> StreamingQuery:
    """Load every batch into the tables under ``root`` and publish the result.

    Deduplicated facts, hourly and daily rollups, newest readings and what was
    set aside are then all read from ``TelemetryTables``.
    """
    tables = TelemetryTables(feed.sparkSession, root)

    def load(batch: DataFrame, batch_id: int) -> None:
        source = source_of(batch.sparkSession, checkpoint)
        tables.load(positioned(batch), batch_id, now(clock), source=source)

    return _start(feed.writeStream.foreachBatch(load), checkpoint, continuous)


def read_facts(spark: SparkSession, root: str) -> DataFrame:
    """One row per reading of all batches so far."""
    return TelemetryTables(spark, root).facts()


def read_rollup(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rollup of the facts so far; ``name`` is hour or day."""
    tables = TelemetryTables(spark, root)
    return tables.daily() if name == "day" else tables.hourly()


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest reading of each device so far."""
    return TelemetryTables(spark, root).latest()
