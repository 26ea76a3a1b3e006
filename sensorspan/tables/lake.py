"""The published tables: facts, hourly and daily rollups, versions.

Layout under one root folder::

    measurements/day=D/             facts; the load number is a column
    hourly_summary/day=D/version=N/ hourly state of one day as of load N
    daily_summary/day=D/version=N/  daily state of one day as of load N
    devices/slot=B/version=N/       one row for each device, in hash buckets
    active/slot=D/version=N/        bitmaps of each hour's devices
    quarantine/load=N/              torn lines, rows without a key or from the future
    attempts/load=N/                load N was begun
    sync_state/version=N/           the watermark and the number of facts
    loads/version=N/                batches brought in, loads that died
    manifest/version=N/             which versions make up each day's state

A load appends its new facts, writes the state of the days they fall on, and then
its manifest. Readers resolve the newest manifest, so they see a load wholly or not
at all, and only days with new facts are ever rewritten. A day's state may be in several
versions, which readers add up. A load merges those that stand for no more loads than
what it has merged so far, like the digits of a binary counter: a day that many loads
touch is rewritten in proportion to the logarithm of their number, not to the number. The table numbers its loads itself. Each batch is named by its
source and its number there, and a batch that was published is not brought in
again, in whatever order they come. A load that dies leaves facts that no reader and no later load sees;
its number is not used again.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SHORT_METHODS, materialise, settings
from ..functions.timebuckets import EPOCH, day_of, epoch_days, hour_ceil, hour_floor, hour_of, moment
from ..operators.dedupe import FEW_ROWS, insert_or_ignore, split_keyed
from ..operators.filters import TIME, last, time_filter
from ..operators.devices import DEVICES, device_rows, device_slots, device_state, merge_devices, renumbered
from ..operators.distinct import BITMAP, count_bitmaps, device_bitmaps, merge_bitmaps
from ..operators.latest import LATEST_ROW, latest_by_device
from ..operators.rollups import (
    STATE,
    bucket_state,
    daily_from_hourly,
    merge_state,
    radiation_moments,
    summary,
)
from ..operators.tables import empty_relation
from ..plans.ingest import ingest
from ..schema import CORRUPT, MEASUREMENT_COLUMNS, MEASUREMENTS, ROLLUP_KEYS
from . import storage
from .slots import Slots

FACTS = "measurements"
HOURLY = "hourly_summary"
DAILY = "daily_summary"

_FACT_FILES = T.StructType(
    [*MEASUREMENTS.fields, T.StructField("load", T.LongType()), T.StructField("day", T.DateType())]
)
_MANIFEST = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("version", T.LongType()),
        T.StructField("loads", T.LongType()),  # that the version's state of the day was merged from
    ]
)
# The versions of a table's day, oldest first, with their loads.
Parts = tuple[tuple[int, int], ...]
_SYNC = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("last_sync_timestamp", T.TimestampNTZType()),
        T.StructField("total_rows", T.LongType()),
    ]
)
_LOADS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("number", T.LongType()),
    ]
)
_ASIDE = T.StructType(
    [
        *MEASUREMENTS.fields,
        T.StructField("reason", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("load", T.LongType()),
    ]
)
# How the columns of the small tables above are built on the driver.
_ARROW = {
    "string": pa.string(),
    "date": pa.date32(),
    "bigint": pa.int64(),
    "timestamp_ntz": pa.timestamp("us"),
}


def _state_schema(*bucket: T.StructField) -> T.StructType:
    text = [T.StructField(k, T.StringType()) for k in ROLLUP_KEYS[:4]]
    place = [T.StructField(k, T.DoubleType()) for k in ROLLUP_KEYS[4:]]
    state = [T.StructField(name, kind) for name, kind in STATE.items()]
    days = [T.StructField("day", T.DateType()), T.StructField("version", T.LongType())]
    return T.StructType([*bucket, *text, *place, *state, *days])


_SCHEMAS = {
    HOURLY: _state_schema(T.StructField("hour", T.TimestampNTZType())),
    DAILY: _state_schema(),
}


# Hourly state of a load's facts, as it is merged.
_HOURS = T.StructType(_SCHEMAS[HOURLY].fields[:-2])
_ACTIVE = T.StructType([T.StructField("hour", T.TimestampNTZType()), *BITMAP.fields])


def _merge_active(held: DataFrame, changed: DataFrame) -> DataFrame:
    both = held.withColumn("slot", F.to_date("hour").cast("string")).unionByName(changed)
    return merge_bitmaps(both, "slot", "hour")


def _hours_of(facts: DataFrame) -> DataFrame:
    return facts.select(hour_of(TIME).alias("hour"), "device_urn").distinct()


class TelemetryTables:
    """Reads and maintains the tables under one root. One writer at a time.

    With ``active`` loads also keep a bitmap of each hour's devices, a hundredth of the
    hourly rollup, from which distinct devices of long ranges are counted. All loads of a root have to agree on it.
    """

    def __init__(self, spark: SparkSession, root: str, active: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keeps_active = active

    # Reading ------------------------------------------------------------

    def versions(self) -> list[int]:
        """Published versions, oldest first. A manifest counts once committed."""
        names = storage.committed(self.spark, f"{self.root}/manifest")
        return sorted(int(name.split("=")[1]) for name in names)

    def current(self) -> int | None:
        published = self.versions()
        return published[-1] if published else None

    def facts(self, version: int | None = None) -> DataFrame:
        """Facts of a version, with their ``day`` partition for pruning."""
        return self._fact_files(version).select(*MEASUREMENT_COLUMNS, "day")

    def hourly(
        self,
        version: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        """Hourly rollup; a range opens only the folders of its days."""
        state = self._state(HOURLY, version, since, until)
        if since is not None:
            state = state.filter(F.col("hour") >= moment(since))
        if until is not None:
            state = state.filter(F.col("hour") <= moment(until))
        return summary(state, "hour")

    def daily(
        self,
        version: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        return summary(self._state(DAILY, version, since, until), "day")

    def daily_state(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """Mergeable state of the days in a range, for rollups of any set of them."""
        return self._state(DAILY, None, since, until)

    def recent(self, as_of: datetime, days: int = 7, version: int | None = None) -> DataFrame:
        """Raw rows of the last days; a pruned scan of the facts."""
        return last(self.facts(version), as_of, days=days)

    def latest(self, version: int | None = None) -> DataFrame:
        """Newest reading per device, from the table that each load merges it into.

        An older version is looked up in the facts: the daily rollup tells each
        device's last day, and only those days are read.
        """
        version = self._resolve(version)
        if version == self.current():
            return self.devices().select(*LATEST_ROW)
        ends = self._state(DAILY, version).groupBy("device_urn").agg(F.max("day").alias("day"))
        days = self._days(ends)
        rows = self.facts(version).filter(F.col("day").isin(days))
        return latest_by_device(rows.join(ends, ["device_urn", "day"], "left_semi"))

    def devices(self) -> DataFrame:
        """A row for each device, as of the newest version: its newest reading, its first time,
        how many readings it has, and the moments of its positive counts."""
        version = self._resolve(None)
        return self._device_table().read(upto=version, without=self._loads(version)[1])

    def radiation_stats(self) -> DataFrame:
        """Mean and deviation of each device's positive counts of all time; no fact is read."""
        return radiation_moments(self.devices(), "device_urn")

    def _active_of(self, hours: DataFrame, version: int, dead: set[int]) -> DataFrame:
        """Bitmaps of some hours' devices (hour, device_urn), whose numbers the device table has as of ``version``."""
        table = self._device_table()
        numbers = table.read(upto=version, without=dead).select(F.col("device_urn").alias("_device"), "number")
        known = hours.select("hour", "device_urn").join(numbers, hours["device_urn"].eqNullSafe(numbers["_device"]))
        return device_bitmaps(known, "hour").withColumn("slot", F.to_date("hour").cast("string"))

    def active(self, since: datetime, until: datetime) -> DataFrame:
        """Bitmaps of the devices of each whole hour in [since, until)."""
        version = self._resolve(None)
        days = {str(since.date() + timedelta(days=n)) for n in range((until.date() - since.date()).days + 1)}
        rows = self._active_table().read(upto=version, without=self._loads(version)[1], slots=days)
        return rows.filter((F.col("hour") >= moment(hour_ceil(since))) & (F.col("hour") < moment(hour_floor(until))))

    def hourly_active_devices(self, frm: datetime, to: datetime) -> DataFrame:
        """Distinct devices of each hour of a range, both ends included. Facts are read for the hours
        at its ends only."""
        distinct = F.count_distinct("device_urn").alias("active_devices")
        if self.keeps_active:
            whole = count_bitmaps(self.active(frm, to), "hour", name="active_devices")
        else:
            whole = self._whole_hours(frm, to).groupBy("hour").agg(distinct)
        ends = self._hour_ends(frm, to).groupBy(hour_of(TIME).alias("hour"))
        ends = ends.agg(distinct)
        return whole.unionByName(ends).withColumnRenamed("hour", "time").orderBy("time")

    def device_count(self, frm: datetime, to: datetime, *keys: str) -> DataFrame:
        """Distinct devices of a range, both ends included.

        All of them are counted by bitmaps, if there are any; else, and by ``keys``, columns of the
        rollups, by the daily state.
        """
        if keys or not self.keeps_active:
            return self.range_state(frm, to).groupBy(*keys).agg(F.count_distinct("device_urn").alias("device_count"))
        ends = self._hour_ends(frm, to)
        version = self._resolve(None)
        few = self._active_of(_hours_of(ends), version, self._loads(version)[1])
        state = self.active(frm, to).unionByName(few.select(*_ACTIVE.names))
        return count_bitmaps(state, name="device_count")

    def _whole_hours(self, frm: datetime, to: datetime) -> DataFrame:
        """Hourly state of the whole hours in [frm, to)."""
        state = self._state(HOURLY, None, frm, to)
        return state.filter((F.col("hour") >= moment(hour_ceil(frm))) & (F.col("hour") < moment(hour_floor(to))))

    def _hour_ends(self, frm: datetime, to: datetime) -> DataFrame:
        """Facts of a range that lie outside its whole hours."""
        first, end = moment(hour_ceil(frm)), moment(hour_floor(to))
        rows = time_filter(self.facts(), frm, to)
        days = sorted({frm.date(), to.date()})
        return rows.filter(F.col("day").isin(days) & ((F.col(TIME) < first) | (F.col(TIME) >= end)))

    def range_state(self, frm: datetime, to: datetime) -> DataFrame:
        """Daily state of a range, both ends included: of whole days the tables', and of the days at its
        ends that of their facts in the range."""
        first = frm.date() if frm == datetime.combine(frm.date(), datetime.min.time()) else frm.date() + timedelta(days=1)
        last_day = to.date() - timedelta(days=1)
        held = {
            day: parts
            for (table, day), parts in self._manifest(self._resolve(None)).items()
            if table == DAILY and first <= day <= last_day
        }
        whole = self._state_days(DAILY, [(day, v) for day, parts in held.items() for v, _ in parts])
        ends = time_filter(self.facts(), frm, to).filter(F.col("day").isin(sorted({frm.date(), to.date()} - set(held))))
        made = bucket_state(ends.drop("day"), day_of(TIME), "day")
        return whole.select("day", *ROLLUP_KEYS, *STATE).unionByName(made)

    def device_uptime(self, frm: datetime, to: datetime) -> DataFrame:
        """First and last reading, and their number, of each device in a range, from state."""
        rows = self.range_state(frm, to).groupBy("device_urn").agg(
            F.min("first_at").alias("first_seen"),
            F.max("last_at").alias("last_seen"),
            F.sum("reading_count").alias("total_readings"),
        )
        return rows.withColumn("days_active", epoch_days(F.col("last_seen"), F.col("first_seen")))

    def daily_activity(self, frm: datetime, to: datetime) -> DataFrame:
        """Readings and distinct devices of each day of a range, from state."""
        days = self.range_state(frm, to).groupBy("day")
        return days.agg(
            F.sum("reading_count").alias("readings_per_day"), F.count_distinct("device_urn").alias("active_devices")
        )

    def _active_table(self) -> Slots:
        return Slots(self.spark, f"{self.root}/active", _ACTIVE)

    def _device_table(self) -> Slots:
        return Slots(self.spark, f"{self.root}/devices", DEVICES)

    def quarantine(self) -> DataFrame:
        """What was set aside, with the reason, the load, and the text of a line that did not parse."""
        return self.spark.read.schema(_ASIDE).parquet(f"{self.root}/quarantine")

    def sync_state(self, version: int | None = None) -> DataFrame:
        """The watermark of a version; an empty relation before the first."""
        version = self.current() if version is None else version
        if version is None:
            return empty_relation(self.spark, _SYNC)
        return self.spark.read.schema(_SYNC).parquet(f"{self.root}/sync_state/version={version}")

    def _resolve(self, version: int | None) -> int:
        found = self.current() if version is None else version
        if found is None:
            raise ValueError(f"nothing is published under {self.root}")
        return found

    def _files(self) -> DataFrame:
        return self.spark.read.schema(_FACT_FILES).parquet(f"{self.root}/{FACTS}")

    def _fact_files(self, version: int | None) -> DataFrame:
        """Facts of the published loads up to a version."""
        found = self._resolve(version)
        dead = sorted(self._loads(found)[1])
        files = self._files().filter(F.col("load") <= found)
        return files.filter(~F.col("load").isin(dead)) if dead else files

    def _loads(self, version: int | None) -> tuple[dict[str, set[int]], set[int]]:
        """The batches of each source, and the loads that died, as of a version."""
        if version is None:
            return {}, set()
        path = f"{self.root}/loads/version={version}"
        rows = self.spark.read.schema(_LOADS).parquet(path).collect()
        batches: dict[str, set[int]] = {}
        for r in rows:
            if r.kind == "batch":
                batches.setdefault(r.source, set()).add(r.number)
        return batches, {r.number for r in rows if r.kind == "dead"}

    def _begun(self) -> set[int]:
        names = storage.children(self.spark, f"{self.root}/attempts")
        return {int(name.split("=")[1]) for name in names}

    def _begin(self, held: int | None) -> tuple[int, set[int]]:
        """The number of a new load, and the loads before it that were never published."""
        begun = self._begun()
        died = {n for n in begun if n > (held or 0)}
        version = max([held or 0, *begun]) + 1
        storage.make(self.spark, f"{self.root}/attempts/load={version}")
        for n in begun - died:
            storage.delete(self.spark, f"{self.root}/attempts/load={n}")
        return version, died

    def _manifest(self, version: int | None) -> dict[tuple[str, date], Parts]:
        """Current versions of each table's days: a few entries per calendar day."""
        if version is None:
            return {}
        path = f"{self.root}/manifest/version={version}"
        rows = self.spark.read.schema(_MANIFEST).parquet(path).collect()
        found: dict[tuple[str, date], Parts] = {}
        for r in sorted(rows, key=lambda r: r.version):
            found[r.table, r.day] = (*found.get((r.table, r.day), ()), (r.version, r.loads or 1))
        return found

    def _state(
        self,
        table: str,
        version: int | None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        entries = self._manifest(self._resolve(version))
        first = since.date() if since else date.min
        final = until.date() if until else date.max
        days = {day: parts for (name, day), parts in entries.items() if name == table and first <= day <= final}
        whole = self._state_days(table, [(day, parts[0][0]) for day, parts in days.items() if len(parts) == 1])
        several = [(day, v) for day, parts in days.items() if len(parts) > 1 for v, _ in parts]
        if not several:
            return whole
        name = "hour" if table == HOURLY else "day"
        merged = merge_state(self._state_days(table, several), F.col(name), name)
        return whole.select(merged.columns).unionByName(merged)

    def _state_days(self, table: str, days: list[tuple[date, int]]) -> DataFrame:
        schema = _SCHEMAS[table]
        if not days:
            return empty_relation(self.spark, schema)
        paths = [f"{self.root}/{table}/day={d.isoformat()}/version={v}" for d, v in sorted(days)]
        base = f"{self.root}/{table}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    # Loading ------------------------------------------------------------

    def load(
        self,
        feed: DataFrame,
        batch: int,
        as_of: datetime,
        batch_time: datetime | None = None,
        position: str = "pos",
        source: str = "feed",
    ) -> dict:
        """Bring in one feed, the ``batch`` of its ``source``, and publish the result.

        A batch that is published already changes nothing, so a feed may be sent
        again, and one with a lower number may come late; other sources count for
        themselves. Lines that did not parse, in a feed read with their texts, are
        set aside. Returns the load's row counts and watermarks, and the version it became.
        """
        def typed(rows: DataFrame) -> DataFrame:
            if CORRUPT in rows.columns:
                rows = rows.filter(F.col(CORRUPT).isNull())
            return ingest(rows, batch_time or as_of, position)

        return self._bring(feed, typed, batch, as_of, position, source)

    def sync(self, other: TelemetryTables, as_of: datetime) -> dict:
        """Bring in what another root's tables have published since the last time.

        What is new there is known by its load, not by its time, so readings
        that came late there come here too. Only those facts and the days they
        touch are read; nothing new there changes nothing here.
        """
        source, newest = f"tables:{other.root}", other._resolve(None)
        seen = max(self._loads(self.current())[0].get(source, {0}))
        rows = other._fact_files(newest).filter(F.col("load") > seen)
        fresh = rows.select(*MEASUREMENT_COLUMNS, F.lit(0).alias("pos"))
        return self._bring(fresh, lambda rows: rows, newest, as_of, "pos", source)

    def _bring(
        self,
        feed: DataFrame,
        typed: Callable[[DataFrame], DataFrame],
        batch: int,
        as_of: datetime,
        position: str,
        source: str,
    ) -> dict:
        held_version = self.current()
        batches, dead = self._loads(held_version)
        if batch in batches.get(source, ()):
            return {"version": held_version, "new": 0, "skipped": True}

        version, died = self._begin(held_version)
        fetched = Observation("fetched")
        torn = F.count(CORRUPT) if CORRUPT in feed.columns else F.lit(0)
        counted = feed.observe(fetched, F.count(F.lit(1)).alias("rows"), torn.alias("torn"))
        rows = typed(counted)
        staging, staged_hours = f"{self.root}/staging/load={version}", f"{self.root}/staging-hours/load={version}"
        with settings(feed.sparkSession, **SHORT_METHODS):
            rows.withColumn("day", day_of(TIME)).write.mode("overwrite").parquet(staging)
        fit, unfit = split_keyed(self.spark.read.parquet(staging), as_of)
        if CORRUPT in feed.columns and not fetched.get["torn"]:
            feed = feed.drop(CORRUPT)  # no line of it has to be looked for
        per_day = {r.day: r["count"] for r in fit.groupBy("day").count().collect()}
        days = sorted(per_day)
        dead_now = dead | died
        with ThreadPoolExecutor(3) as pool:  # jobs that do not wait for each other
            setting_aside = pool.submit(self._set_aside, feed, unfit, version)
            self._append(fit, per_day, version, held_version, position)
            own = self._files().filter(F.col("day").isin(days) & (F.col("load") == version))
            newest = F.max(F.when(F.col(TIME) <= moment(as_of), F.col(TIME))).alias("newest")
            added = own.groupBy("day").agg(F.count(F.lit(1)).alias("new"), newest).collect()
            # A day of which the feed only repeats held facts stays as it is.
            fresh: dict[tuple[str, date], Parts] = {}
            if added:
                changed = sorted(r.day for r in added)
                own = own.filter(F.col("day").isin(changed))
                # Written before it is cached: a cached aggregate keeps all shuffle partitions, however few its rows.
                bucket_state(own, hour_of(TIME), "hour").write.mode("overwrite").parquet(staged_hours)
                hours = self.spark.read.schema(_HOURS).parquet(staged_hours).persist()
                merging = pool.submit(self._merge, hours, changed, version, held_version)
                self._merge_devices(own, hours, version, dead_now)
                fresh = merging.result()
                hours.unpersist()
            aside = setting_aside.result()
        set_aside = sum(aside.values())

        new = sum(r.new for r in added)
        before = self.sync_state(held_version).first() if held_version is not None else None
        old_mark = before.last_sync_timestamp if before else datetime.fromisoformat(EPOCH)
        new_mark = max([old_mark, *(r.newest for r in added if r.newest)])
        total = (before.total_rows if before else 0) + new
        loads = {**batches, source: batches.get(source, set()) | {batch}}, dead_now
        self._publish(version, held_version, fresh, new_mark, total, loads)
        storage.delete(self.spark, staging)
        storage.delete(self.spark, staged_hours)
        return {
            "version": version,
            "fetched": fetched.get["rows"],
            "valid": sum(per_day.values()) + set_aside - aside.get("torn", 0),
            "quarantined": set_aside,
            "new": new,
            "total": total,
            "old_watermark": old_mark,
            "new_watermark": new_mark,
            "skipped": False,
        }

    def _merge_devices(self, new: DataFrame, hours: DataFrame, version: int, dead: set[int]) -> None:
        """Bring what new facts, and their hourly state, add into the table of devices, and then into that of active ones."""
        self._device_table().merge(version, device_slots(device_rows(new)), merge_devices, dead)
        if self.keeps_active:
            self._active_table().merge(version, self._active_of(hours, version, dead), _merge_active, dead)

    def _set_aside(self, feed: DataFrame, unfit: DataFrame, version: int) -> dict[str, int]:
        """Keep what can't be a fact, with the reason; how many rows there are for each."""
        none = F.lit(None).cast("string")
        keyless = F.col("device").isNull() | F.col(TIME).isNull()
        reason = F.when(keyless, "keyless").otherwise("future").alias("reason")
        rows = unfit.select(*MEASUREMENT_COLUMNS, reason, none.alias("line"))
        if CORRUPT in feed.columns:
            torn = feed.filter(F.col(CORRUPT).isNotNull())
            # Of a line's fields only the device's name is taken, if it came before the tear.
            known = [
                F.col(f.name) if f.name == "device_urn" else F.lit(None).cast(f.dataType).alias(f.name)
                for f in MEASUREMENTS.fields
            ]
            rows = rows.unionByName(torn.select(*known, F.lit("torn").alias("reason"), F.col(CORRUPT).alias("line")))
        path = f"{self.root}/quarantine/load={version}"
        rows.write.mode("overwrite").parquet(path)
        kept = self.spark.read.schema(T.StructType(_ASIDE.fields[:-1])).parquet(path)
        return {r.reason: r["count"] for r in kept.groupBy("reason").count().collect()}

    def _days(self, rows: DataFrame) -> list[date]:
        """Calendar days of some rows, to prune partitions with literals."""
        return sorted(r.day for r in rows.select("day").distinct().collect())

    def _append(
        self, fit: DataFrame, per_day: dict[date, int], version: int, held_version: int | None, position: str
    ) -> None:
        path = f"{self.root}/{FACTS}"
        if held_version is not None:
            held = self._fact_files(held_version).filter(F.col("day").isin(sorted(per_day)))
        else:
            held = empty_relation(self.spark, _FACT_FILES)
        new = insert_or_ignore(fit, held, [position], few=sum(per_day.values()) <= FEW_ROWS)
        (
            new.drop(position)
            .withColumn("load", F.lit(version).cast("bigint"))
            .hint("rebalance", "day")
            .write.mode("append")
            .partitionBy("day")
            .parquet(path)
        )

    def _merge(
        self, hours: DataFrame, days: list[date], version: int, held_version: int | None
    ) -> dict[tuple[str, date], Parts]:
        """Merge the hourly state of new facts into the smaller parts of that of their days, as ``version``.

        Only this and those parts are read. Returns what makes up these days then.
        """
        entries, first = self._manifest(held_version), self._hours_from()
        joined: dict[str, list[tuple[date, int]]] = {HOURLY: [], DAILY: []}
        fresh: dict[tuple[str, date], Parts] = {}
        for table, day in ((t, d) for t in joined for d in days if t == DAILY or d >= first):
            parts, loads = entries.get((table, day), ()), 1
            while parts and parts[-1][1] <= loads:
                joined[table].append((day, parts[-1][0]))
                loads += parts[-1][1]
                parts = parts[:-1]
            fresh[table, day] = (*parts, (version, loads))

        def whole(table: str, state: DataFrame, name: str) -> DataFrame:
            held = self._state_days(table, joined[table])
            if not joined[table]:  # the state has each key once
                return state
            return merge_state(state.unionByName(held.select(state.columns)), F.col(name), name)

        # Hours before the retained ones are not kept; of a late reading only its day is.
        hourly = whole(HOURLY, hours, "hour").withColumn("day", day_of("hour"))
        hourly = hourly.filter(F.col("day") >= F.lit(first.isoformat()).cast("date"))
        daily = whole(DAILY, daily_from_hourly(hours), "day")
        with ThreadPoolExecutor(1) as pool:
            writing = pool.submit(self._write_state, HOURLY, hourly, version)
            self._write_state(DAILY, daily, version)
            writing.result()
        return fresh

    def _hours_from(self) -> date:
        """The first day whose hours are kept."""
        names = storage.children(self.spark, f"{self.root}/hours_from")
        return max((date.fromisoformat(name.split("=")[1]) for name in names), default=date(1, 1, 1))

    def refresh(self, version: int, held_version: int) -> list[date]:
        """Recompute all rollups from the published facts, as ``version``.

        The facts are read once; daily state comes from the hourly state.
        """
        facts = self._fact_files(held_version)
        dead = self._loads(held_version)[1]
        with ThreadPoolExecutor(1) as pool:
            devices = pool.submit(self._rebuild_devices, facts, version, dead)
            days = self._rebuild_rollups(facts, version)
            devices.result()
        return days

    def _rebuild_rollups(self, facts: DataFrame, version: int) -> list[date]:
        hourly = bucket_state(facts, hour_of(TIME), "hour").withColumn("day", day_of("hour"))
        self._write_state(HOURLY, hourly, version)
        written = storage.children(self.spark, f"{self.root}/{HOURLY}")
        days = [
            date.fromisoformat(name.split("=")[1])
            for name in written
            if name.startswith("day=")
            and storage.exists(self.spark, f"{self.root}/{HOURLY}/{name}/version={version}")
        ]
        fresh = self._state_days(HOURLY, [(day, version) for day in days])
        self._write_state(DAILY, daily_from_hourly(fresh), version)
        return days

    def _rebuild_devices(self, facts: DataFrame, version: int, dead: set[int]) -> None:
        """The device table from facts alone; devices without facts leave it."""
        table, active = self._device_table(), self._active_table()
        held = materialise(table.read(upto=version - 1, without=dead), "devices")
        table.replace(version, renumbered(device_state(facts), held), table.slots(), dead)
        if self.keeps_active:
            active.replace(version, self._active_of(_hours_of(facts), version, dead), active.slots(), dead)

    def _write_state(self, table: str, state: DataFrame, version: int) -> None:
        (
            state.withColumn("version", F.lit(version).cast("bigint"))
            .hint("rebalance", "day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "version")
            .parquet(f"{self.root}/{table}")
        )

    def _unused(self, version: int) -> tuple[int, tuple[dict[str, set[int]], set[int]]]:
        """The published version and its loads, if ``version`` is a number not used yet."""
        held, begun = self._resolve(None), self._begun()
        if version <= max([held, *begun]):
            raise ValueError(f"version {version} is used already; {held} is published")
        batches, dead = self._loads(held)
        return held, (batches, dead | {n for n in begun if n > held})

    def rebuild(self, version: int, as_of: datetime) -> None:
        """Recompute all rollups from all facts and publish them."""
        held, loads = self._unused(version)
        days = self.refresh(version, held)
        state = self.sync_state(held).first()
        first = self._hours_from()
        fresh = {(t, day): ((version, 1),) for t in (HOURLY, DAILY) for day in days if t == DAILY or day >= first}
        self._publish(version, held, fresh, state.last_sync_timestamp, state.total_rows, loads)

    def _publish(
        self,
        version: int,
        previous: int | None,
        fresh: dict[tuple[str, date], Parts],
        mark: datetime,
        total: int,
        loads: tuple[dict[str, set[int]], set[int]],
    ) -> None:
        """Write the watermark, then the manifest that makes the version visible."""
        self._write_manifest(version, {**self._manifest(previous), **fresh}, mark, total, loads)

    def _write_manifest(
        self,
        version: int,
        entries: dict[tuple[str, date], Parts],
        mark: datetime,
        total: int,
        loads: tuple[dict[str, set[int]], set[int]],
    ) -> None:
        sync = {"table_name": [FACTS], "last_sync_timestamp": [mark], "total_rows": [total]}
        batches, dead = loads
        known = [("batch", source, n) for source, numbers in sorted(batches.items()) for n in sorted(numbers)]
        known += [("dead", "", n) for n in sorted(dead)]
        rows = [(table, day, v, n) for (table, day), parts in sorted(entries.items()) for v, n in parts]
        def write(folder: str, schema: T.StructType, data: dict) -> None:
            arrays = {
                f.name: pa.array(data[f.name], _ARROW[f.dataType.simpleString()])
                for f in schema.fields
            }
            small = self.spark.createDataFrame(pa.table(arrays), schema)
            small.coalesce(1).write.mode("overwrite").parquet(
                f"{self.root}/{folder}/version={version}"
            )

        def columns(schema: T.StructType, found: list[tuple]) -> dict:
            return dict(zip(schema.names, zip(*found) if found else [()] * len(schema.names)))

        with ThreadPoolExecutor(1) as pool:
            syncing = pool.submit(write, "sync_state", _SYNC, sync)
            write("loads", _LOADS, columns(_LOADS, known))
            syncing.result()
        write("manifest", _MANIFEST, columns(_MANIFEST, rows))

    # Keeping ------------------------------------------------------------

    def expire(self, keep: int = 30) -> list[int]:
        """Drop all but the newest versions, and rollup days only they used."""
        published = self.versions()
        kept, dropped = published[-keep:], published[:-keep]

        def folders(versions: list[int]) -> set[tuple[str, date, int]]:
            return {(*key, n) for v in versions for key, parts in self._manifest(v).items() for n, _ in parts}

        stale = folders(dropped) - folders(kept)
        for version in dropped:
            storage.delete(self.spark, f"{self.root}/manifest/version={version}")
            storage.delete(self.spark, f"{self.root}/sync_state/version={version}")
            storage.delete(self.spark, f"{self.root}/loads/version={version}")
        for table, day, version in stale:
            storage.delete(
                self.spark, f"{self.root}/{table}/day={day.isoformat()}/version={version}"
            )
        return kept

    def drop_before(self, day: date, version: int) -> None:
        """Retention: publish a version without the days before ``day``.

        Whole partitions go; facts of the remaining days are not rewritten.
        Only the new version is whole afterwards: the dropped facts are gone
        from older ones too, which are therefore expired.
        """
        held, loads = self._unused(version)
        entries = {key: v for key, v in self._manifest(held).items() if key[1] >= day}
        state = self.sync_state(held).first()
        left = self._fact_files(held).filter(F.col("day") >= F.lit(day)).count()
        kept = self._fact_files(held).filter(F.col("day") >= F.lit(day))
        self._rebuild_devices(kept, version, loads[1])
        self._write_manifest(version, entries, state.last_sync_timestamp, left, loads)
        self.expire(keep=1)
        for name in storage.children(self.spark, f"{self.root}/{FACTS}"):
            if name.startswith("day=") and date.fromisoformat(name.split("=")[1]) < day:
                storage.delete(self.spark, f"{self.root}/{FACTS}/{name}")

    def drop_hours_before(self, day: date, version: int) -> None:
        """Retention of the hourly rollup alone: publish a version without its days before ``day``.

        Facts and daily state stay. Late readings of those days still change their day,
        and a rebuild does not bring the hours back.
        """
        held, loads = self._unused(version)
        storage.make(self.spark, f"{self.root}/hours_from/day={day.isoformat()}")
        entries = {(t, d): v for (t, d), v in self._manifest(held).items() if t != HOURLY or d >= day}
        state = self.sync_state(held).first()
        self._write_manifest(version, entries, state.last_sync_timestamp, state.total_rows, loads)

    def compact(self, days: list[date]) -> None:
        """Rewrite closed days as few files ordered by device and time.

        Facts of loads that died go. Run it while nothing reads those days.
        """
        order = ["day", "device_urn", TIME]
        rows = self._fact_files(None).filter(F.col("day").isin(days))
        (
            materialise(rows, "compacted")
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(f"{self.root}/{FACTS}")
        )
