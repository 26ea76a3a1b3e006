"""Streams whose memory is Spark's state store.

The jobs in ``jobs`` compare every batch with all facts held, so lateness has no
bound. The ones here keep only what a bound on lateness asks for, and never
read what they have written. Rows that cannot be facts are set aside before
any state: a torn line, a reading without a time or a device, or one from the
future moves no watermark.

Batches are written under their number, so one that runs again after a crash
replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import SHORT_METHODS, settings
from ..functions.timebuckets import from_instant, moment, to_instant
from ..operators.dedupe import newest_per_key, unmatched
from ..operators.devices import NEWEST, device_slots
from ..operators.filters import TIME, all_present
from ..operators.latest import LATEST_COLUMNS, LATEST_ROW, latest_order
from ..operators.rollups import STATE, state_columns, summary
from ..plans.ingest import clean_feed, enforce_schema
from ..schema import CORRUPT, FACT_KEY, MEASUREMENT_COLUMNS, MEASUREMENTS, ROLLUP_KEYS
from ..tables import storage
from ..tables.slots import SLOT, Parts, Slots

BOUND = timedelta(days=7)
SILENCE = timedelta(days=30)

EVENT_TIME = "event_time"
KIND = "kind"
LINE = "line"
# What becomes of a row.
FIT, FACT, LATE, TORN, TIMELESS, KEYLESS, FUTURE = "fit", "fact", "late", "torn", "timeless", "keyless", "future"
ASIDE = (LATE, TORN, TIMELESS, KEYLESS, FUTURE)


def classified(feed: DataFrame, clock: datetime | None = None) -> DataFrame:
    """Cleaned and typed rows of a feed with their ``kind``, and the ``line`` of what did not parse.

    A row is fit if it has a device and a time no more than a day ahead of ``clock``, the
    time of the batch by default. ``event_time`` is the reading's time as an instant.
    """
    now = moment(clock) if clock else from_instant(F.current_timestamp())
    line = F.col(CORRUPT) if CORRUPT in feed.columns else F.lit(None).cast("string")
    rows = enforce_schema(clean_feed(feed.withColumn(LINE, line), now, LINE), LINE)
    kind = (
        F.when(F.col(LINE).isNotNull(), TORN)
        .when(F.col(TIME).isNull(), TIMELESS)
        .when(~all_present(FACT_KEY), KEYLESS)
        .when(F.col(TIME) > F.timestamp_add("DAY", F.lit(1), now), FUTURE)
        .otherwise(FIT)
    )
    return rows.withColumn(KIND, kind).withColumn(EVENT_TIME, to_instant(F.col(TIME)))


def _interval(length: timedelta) -> str:
    return f"{length // timedelta(microseconds=1)} microseconds"


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
STORES_PER_CORE = 2


def _start(
    rows: DataFrame, write, mode: str, checkpoint: str, continuous: str | None, **changed: str
) -> StreamingQuery:
    """Start a stream whose state lies in a few stores for each core.

    Every batch opens and commits each store, with rows or without, and a checkpoint keeps their number.
    """
    spark = rows.sparkSession
    stores = min(int(spark.conf.get(PARTITIONS)), STORES_PER_CORE * spark.sparkContext.defaultParallelism)
    writer = rows.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    with settings(spark, **{PARTITIONS: str(stores), **SHORT_METHODS, **changed}):
        return writer.start()


def _once(rows: DataFrame, bound: timedelta) -> DataFrame:
    """The first arrival of every key whose time is within ``bound`` of the newest."""
    return rows.withWatermark(EVENT_TIME, _interval(bound)).dropDuplicatesWithinWatermark(list(FACT_KEY))


# Deduplication ----------------------------------------------------------------

_FILES = T.StructType(
    [
        *MEASUREMENTS.fields,
        T.StructField(LINE, T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField(KIND, T.StringType()),
        T.StructField("day", T.DateType()),
    ]
)


def stream_dedupe(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    clock: datetime | None = None,
    bound: timedelta = BOUND,
    continuous: str | None = None,
) -> StreamingQuery:
    """Every reading once, by keys in the state store; ``facts`` and ``set_aside`` read the result.

    The state holds the keys of the last ``bound`` before the newest reading of the
    batches so far, whatever has been published. A fit row older than that can't be told
    from a repeat and is set aside as late, with its values; ``late_readings`` finds those
    that no fact has. Among copies in one batch any may win.
    """
    rows = classified(feed, clock)
    new = _once(rows.where(F.col(KIND) == FIT), bound).withColumn(KIND, F.lit(FACT))

    spark = feed.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = _newest_time(spark, path, batch_id - 1)
        late = F.lit(False)
        if newest is not None:
            late = F.col(EVENT_TIME) <= F.timestamp_micros(F.lit(newest - bound // timedelta(microseconds=1)))
        # Of the facts those within the bound stay; of all fit rows those beyond it. Together they lack none.
        kept = batch.where(F.when(F.col(KIND) == FACT, ~late).when(F.col(KIND) == FIT, late).otherwise(True))
        kind = F.when(F.col(KIND) == FIT, LATE).otherwise(F.col(KIND))
        folder, staging = f"{path}/batches/batch_id={batch_id}", f"{path}-staging/batch_id={batch_id}"
        kept = kept.withColumn(KIND, kind).withColumn("day", F.to_date(TIME)).drop(EVENT_TIME)
        # Written first: a stream with state plans without AQE, so each of its stores would leave a file for each day.
        kept.write.mode("overwrite").parquet(staging)
        rows = spark.read.schema(kept.schema).parquet(staging)
        rows.hint("rebalance", KIND, "day").write.mode("overwrite").partitionBy(KIND, "day").parquet(folder)
        times = rows.where(F.col(KIND) == FACT).select(F.unix_micros(to_instant(F.col(TIME))).alias("newest"))
        mark = times.agg(F.greatest(F.max("newest"), F.lit(newest).cast("long")).alias("newest"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")
        storage.delete(spark, f"{path}/newest/batch_id={batch_id - 2}")
        storage.delete(spark, staging)

    return _start(new.unionByName(rows), write, "append", checkpoint, continuous)


def _newest_time(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest event time of the batches up to one, in microseconds."""
    folder = f"{path}/newest/batch_id={batch_id}"
    return spark.read.schema("newest long").parquet(folder).first()[0] if storage.exists(spark, folder) else None


def _batches(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    return spark.read.schema(_FILES).option("basePath", f"{path}/batches").parquet(folder or f"{path}/batches")


def facts(spark: SparkSession, path: str) -> DataFrame:
    """One row for each reading, with its ``day`` partition."""
    return _batches(spark, path).where(F.col(KIND) == FACT).select(*MEASUREMENT_COLUMNS, "day")


def set_aside(spark: SparkSession, path: str) -> DataFrame:
    """Rows that are no facts, with their kind, batch and, if it did not parse, their line."""
    rows = _batches(spark, path).where(F.col(KIND).isin(*ASIDE))
    return rows.select(*MEASUREMENT_COLUMNS, LINE, "batch_id", KIND)


def late_readings(spark: SparkSession, path: str) -> DataFrame:
    """Late readings that are not among the facts, once each; days of late rows are all that is compared."""
    rows = _batches(spark, path)
    late = rows.where(F.col(KIND) == LATE).select(*MEASUREMENT_COLUMNS, "day").dropDuplicates(list(FACT_KEY))
    known = rows.where(F.col(KIND) == FACT).select(*FACT_KEY, "day")
    return unmatched(late, known.join(late.select("day").distinct(), "day", "left_semi")).select(*MEASUREMENT_COLUMNS)


# Event-time windows -------------------------------------------------------------


def _window_schema(name: str) -> T.StructType:
    keys = [MEASUREMENTS[key] for key in ROLLUP_KEYS]
    return T.StructType([T.StructField(name, T.TimestampNTZType()), *keys, *(T.StructField(c, kind) for c, kind in STATE.items())])


def window_table(spark: SparkSession, path: str, name: str) -> Parts:
    """The state of the windows, in one slot a day; a batch that changes windows of a day does not rewrite the others."""
    return Parts(spark, path, _window_schema(name), (name, *ROLLUP_KEYS))


def stream_windows(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "hour",
    clock: datetime | None = None,
    bound: timedelta = BOUND,
    continuous: str | None = None,
) -> StreamingQuery:
    """Rollup of the readings in windows of event time, an hour or a day (``name``) wide.

    Readings are deduplicated and aggregated in the state store, which lets a window go
    when the newest reading is ``bound`` ahead of its end. Windows that a batch changed are
    merged into the table by their key; running a batch again changes nothing.
    Readings later than the bound are counted by the stream's progress and not here.
    """
    fit = _once(classified(feed, clock).where(F.col(KIND) == FIT), bound)
    states = fit.groupBy(F.window(EVENT_TIME, f"1 {name}").alias("window"), *ROLLUP_KEYS).agg(*state_columns())
    spark = feed.sparkSession
    table = window_table(spark, path, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn(name, from_instant(F.col("window.start")))
        staging = f"{path}-staging/batch_id={batch_id}"
        # Written first: the state store is to be updated by one job only.
        batch.select(*table.schema.names).write.mode("overwrite").parquet(staging)
        changed = spark.read.schema(table.schema).parquet(staging).withColumn(SLOT, F.to_date(name).cast("string"))
        table.merge(batch_id, changed)
        storage.delete(spark, staging)

    return _start(states, write, "update", checkpoint, continuous)


def read_windows(spark: SparkSession, path: str, name: str = "hour", days: list[str] | None = None) -> DataFrame:
    """The published columns of the windows so far; ``days`` (texts) opens only those days."""
    rows = window_table(spark, path, name).read(slots=days)
    published = summary(rows, name)
    return published.withColumn(name, F.to_date(name)) if name == "day" else published


# Newest readings ------------------------------------------------------------------

# What a device's state holds, in the order by which equal times are settled; nulls are least.
_HELD = ("micros", "device_sn", "loc_country", "loc_name", "loc_lat", "loc_lon", "radiation")
_HELD_SCHEMA = "micros long, device_sn string, loc_country string, loc_name string, loc_lat double, loc_lon double, radiation string"
# The same of each device of a bucket, with the time when it last sent something, as it is packed into the bucket's state.
_STATE_SCHEMA = pa.schema(
    [
        ("device_urn", pa.string()),
        ("micros", pa.int64()),
        *((name, pa.string()) for name in _HELD[1:4]),
        *((name, pa.float64()) for name in _HELD[4:6]),
        ("radiation", pa.string()),
        ("heard", pa.int64()),
    ]
)
# Buckets of devices in the state: Python is called for each that a batch touches.
STATE_BUCKETS = 1024


def newest_table(spark: SparkSession, path: str) -> Slots:
    """The newest reading of each device, in hash buckets of devices."""
    return Slots(spark, path, NEWEST)


def merge_newest(held: DataFrame, changed: DataFrame) -> DataFrame:
    """The greater of the held and the changed row of each device."""
    both = device_slots(held).unionByName(changed)
    return newest_per_key(both, ["device_urn"], latest_order(NEWEST.names))


def _greater(row: tuple) -> tuple:
    return tuple((value is not None, value) for value in row)


def _rank(row: tuple) -> tuple:
    """The order of rows (``_HELD``) of one device; nulls are least."""
    micros, *texts, lat, lon, radiation = (None if pd.isna(value) else value for value in row)
    return _greater((int(micros), *texts, lat, lon, None if radiation is None else int(radiation)))


def _newest_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """The newest row of each device of a frame. Only rows at a device's newest time that differ are compared one by one."""
    ends = frame[frame["micros"] == frame.groupby("device_urn", sort=False)["micros"].transform("max")].drop_duplicates()
    several = ends["device_urn"].duplicated(keep=False).to_numpy()
    if not several.any():
        return ends
    best: dict[str, int] = {}
    ranks = [_rank(row) for row in ends[list(_HELD)].itertuples(index=False, name=None)]
    for i, device in enumerate(ends["device_urn"]):
        if device not in best or ranks[i] > ranks[best[device]]:
            best[device] = i
    return ends.iloc[list(best.values())]


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, schema=_STATE_SCHEMA, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(state).read_all().to_pandas()


def _keep_newest(silence_ms: int):
    """The newest row of each device of a bucket; the state holds the bucket's devices that are not silent."""
    columns = ["device_urn", *_HELD]

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # so have all of its devices
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        held = _unpacked(state.get[0]) if state.exists else None
        sent = None
        for frame in frames:
            sent = _newest_rows(frame[columns] if sent is None else pd.concat([sent, frame[columns]]))
        if sent is None or sent.empty:
            return
        if held is None:
            both = changed = sent
        else:
            both = _newest_rows(pd.concat([held[columns], sent]))
            changed = pd.concat([held[columns], held[columns], both]).drop_duplicates(keep=False)
        heard = pd.Series(now, index=sent["device_urn"])
        if held is not None:
            earlier = held.set_index("device_urn")["heard"]
            heard = pd.concat([heard, earlier[(earlier + silence_ms > now) & ~earlier.index.isin(heard.index)]])
        both = both[both["device_urn"].isin(heard.index)]
        state.update((_packed(both.assign(heard=heard.reindex(both["device_urn"]).to_numpy())),))
        state.setTimeoutDuration(silence_ms)
        if not changed.empty:
            yield changed

    return update


def stream_newest(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    clock: datetime | None = None,
    silence: timedelta = SILENCE,
    continuous: str | None = None,
) -> StreamingQuery:
    """The newest reading of each device, whatever the order of arrival; ``read_newest`` reads it.

    The state holds a row for each device, packed into one for each bucket of devices, and lets go of those that were
    silent for ``silence``, by the clock of the cluster, when their bucket is next opened: no reading is too late. Only devices whose
    newest reading changed reach the table, where the greater row stays, so a device that
    comes back after its state went is right, too.
    """
    columns = [c for c in LATEST_COLUMNS if c != "device_urn"]
    fit = classified(feed, clock).where(F.col(KIND) == FIT)
    rows = fit.select(
        "device_urn", F.unix_micros(EVENT_TIME).alias("micros"), *columns, F.col("lnd_7318u").cast("string").alias("radiation")
    )
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("device_urn"), F.lit(STATE_BUCKETS)))
    updates = bucketed.groupBy("bucket").applyInPandasWithState(
        _keep_newest(silence // timedelta(milliseconds=1)),
        f"device_urn string, {_HELD_SCHEMA}",
        "devices binary",
        "update",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    spark = feed.sparkSession
    table = newest_table(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        time = from_instant(F.timestamp_micros("micros")).alias("last_reading")
        named = batch.select(*LATEST_COLUMNS, F.col("radiation").cast("long").alias("radiation"), time)
        staging = f"{path}-staging/batch_id={batch_id}"
        named.write.mode("overwrite").parquet(staging)
        table.merge(batch_id, device_slots(spark.read.schema(NEWEST).parquet(staging)), merge_newest)
        storage.delete(spark, staging)

    # No batch without rows: state that times out by the clock would ask for one after another, without an end.
    return _start(updates, write, "update", checkpoint, continuous, **{NO_DATA_BATCHES: "false"})


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest reading of each device so far."""
    return newest_table(spark, path).read().select(*LATEST_ROW)
