"""Streaming jobs run to the end of a landed feed; each must end where the
batch query does.

The feed is what devices send. Every reading comes twice, in different files;
some devices also send one without a time. Before all of that, in the first
batch, there is a reading from the year 2080 and one without a device.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..config import scratch_path
from ..functions.timebuckets import moment
from ..operators.dedupe import newest_per_key
from ..operators.filters import TIME
from ..schema import FEED_FIELDS, MEASUREMENT_COLUMNS
from ..streaming import jobs, stateful
from ..tables.lake import TelemetryTables
from .core import _VIEWS, AS_OF, FEED_FROM, HELD_UNTIL, measurements, query, sql_with, ts

FILES_PER_BATCH = 2
TIMELESS = "air:%"
_TEXTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def sql_sent(body: str, *views: str) -> str:
    """``body`` over views of all that was sent: a reading without a time counts at the batch's time."""
    timeless = (
        f"SELECT * REPLACE ({ts(AS_OF)} AS when_captured) FROM (SELECT DISTINCT ON (device_urn) *"
        f" FROM once WHERE device_urn LIKE '{TIMELESS}' ORDER BY device_urn, when_captured DESC)"
    )
    parts = [
        f"once AS ({_VIEWS['m'][1]})",
        f"m AS (SELECT * FROM once UNION ALL (SELECT * FROM ({timeless})))",
        *(f"{name} AS ({_VIEWS[name][1]})" for name in views),
    ]
    return f"WITH {', '.join(parts)} {body}"


def _texts(facts):
    return facts.select(*[F.col(name).cast("string").alias(name) for name in FEED_FIELDS])


def _land(rows, path: str) -> None:
    rows.hint("rebalance").write.mode("append").options(**_TEXTS).json(path)


def _sent(spark, sf) -> str:
    """The landing folder, file after file."""
    path = scratch_path(spark, "landing")
    facts = measurements(spark, sf)
    one = _texts(facts).limit(1)
    future = one.withColumn(TIME, F.lit("2080-01-09 00:00:00"))
    _land(future.unionByName(one.withColumn("device", F.lit("abc"))), path)
    newest = newest_per_key(facts.filter(F.col("device_urn").like(TIMELESS)), ["device_urn"], [TIME])
    timeless = _texts(newest).withColumn(TIME, F.lit(None).cast("string"))
    for _ in range(2):
        _land(_texts(facts).unionByName(timeless), path)
    return path


def _stream(spark, path: str):
    return jobs.read_feed(spark, path, files_per_batch=FILES_PER_BATCH)


_STREAMED: dict[tuple[str, str], str] = {}


def _published(spark, sf) -> str:
    """Tables that one stream has filled, once per application for all readers."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STREAMED:
        root, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "checkpoint")
        jobs.stream_publish(
            _stream(spark, _sent(spark, sf)), root, checkpoint, lambda: AS_OF
        ).awaitTermination()
        _STREAMED[key] = root
    return _STREAMED[key]


@query("stream_ingest", sql_with("SELECT * FROM m", "m"))
def stream_ingest(spark, sf):
    """Each batch by itself; every reading is sent once."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "stream-ingest")
    _land(_texts(measurements(spark, sf)), landing)
    checkpoint = scratch_path(spark, "checkpoint")
    jobs.stream_ingest(_stream(spark, landing), path, checkpoint, lambda: AS_OF).awaitTermination()
    return spark.read.parquet(path).select(*MEASUREMENT_COLUMNS)


@query("stream_dedupe", sql_sent("SELECT * FROM m"))
def stream_dedupe(spark, sf):
    return jobs.read_facts(spark, _published(spark, sf)).select(*MEASUREMENT_COLUMNS)


@query("stream_hourly", sql_sent("SELECT * FROM h", "h"))
def stream_hourly(spark, sf):
    return jobs.read_rollup(spark, _published(spark, sf), "hour")


@query("stream_daily", sql_sent("SELECT * FROM d", "d"))
def stream_daily(spark, sf):
    return jobs.read_rollup(spark, _published(spark, sf), "day")


@query(
    "stream_latest",
    sql_sent(
        "SELECT DISTINCT ON (device_urn) device_urn, device_sn, loc_country, loc_name, loc_lat,"
        " loc_lon, lnd_7318u AS radiation, when_captured AS last_reading FROM m"
        " ORDER BY device_urn, when_captured DESC"
    ),
)
def stream_latest(spark, sf):
    return jobs.read_latest(spark, _published(spark, sf))


@query("stream_upsert_publish", sql_sent("SELECT * FROM h", "h"))
def stream_upsert_publish(spark, sf):
    """The published hourly rollup, by way of the tables."""
    return TelemetryTables(spark, _published(spark, sf)).hourly()


@query("stream_publish_facts", sql_sent("SELECT * FROM m"))
def stream_publish_facts(spark, sf):
    """The published facts, by way of the tables."""
    return TelemetryTables(spark, _published(spark, sf)).facts().select(*MEASUREMENT_COLUMNS)


@query(
    "stream_quarantine",
    "SELECT TIMESTAMP '2080-01-09 00:00:00' AS when_captured, CAST(1 AS BIGINT) AS rows"
    " UNION ALL SELECT NULL, 1",
)
def stream_quarantine(spark, sf):
    """What the stream set aside: the reading from the future, and the one without a device."""
    aside = TelemetryTables(spark, _published(spark, sf)).quarantine()
    when = F.when(F.col("device").isNotNull(), F.col(TIME)).alias(TIME)
    return aside.groupBy(when).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "stream_after_load",
    sql_with("SELECT *, (SELECT CAST(SUM(reading_count) AS BIGINT) FROM d) AS rolled_up FROM m", "m", "d"),
)
def stream_after_load(spark, sf):
    """A batch load, then a stream on the same tables whose feed overlaps it."""
    root, checkpoint = scratch_path(spark, "after-load"), scratch_path(spark, "checkpoint")
    landing = scratch_path(spark, "landing")
    lake = TelemetryTables(spark, root)
    facts = measurements(spark, sf)
    held = facts.filter(F.col(TIME) < moment(HELD_UNTIL))
    lake.load(_texts(held).withColumn("pos", F.lit(0)), 7, AS_OF)
    _land(_texts(facts.filter(F.col(TIME) >= moment(FEED_FROM))), landing)
    jobs.stream_publish(_stream(spark, landing), root, checkpoint, lambda: AS_OF).awaitTermination()
    rolled_up = lake.daily().agg(F.sum("reading_count")).scalar()
    return lake.facts().select(*MEASUREMENT_COLUMNS, rolled_up.alias("rolled_up"))


# Streams with state -----------------------------------------------------------
#
# The readings from FEED_FROM on arrive first, some of them twice, with torn lines, a reading
# from the future and one without a device; the earlier ones come when the stream goes on after
# a stop. A bound of days makes those late; one of months takes them.

WIDE, NARROW = timedelta(days=60), timedelta(days=2)
TORN_LINES = ('{"device": "5", "when_captu', "not json")
_STATEFUL: dict[tuple, str] = {}


def _with_defects(spark, facts, path: str) -> None:
    one = _texts(facts).limit(1)
    future = one.withColumn(TIME, F.lit("2080-01-09 00:00:00"))
    _land(future.unionByName(one.withColumn("device", F.lit("abc"))), path)
    lines = spark.range(len(TORN_LINES)).select(F.element_at(F.array(*map(F.lit, TORN_LINES)), (F.col("id") + 1).cast("int")).alias("value"))
    lines.write.mode("append").text(path)


def _stateful(spark, sf, name: str, bound: timedelta | None, start) -> str:
    """What a stream has made of the two arrivals, once per application for all readers."""
    key = (spark.sparkContext.applicationId, sf, name, bound)
    if key not in _STATEFUL:
        landing, path, checkpoint = (scratch_path(spark, part) for part in (f"{name}-landing", name, f"{name}-checkpoint"))
        facts = measurements(spark, sf)
        newer = facts.filter(F.col(TIME) >= moment(FEED_FROM))
        _with_defects(spark, newer, landing)
        _land(_texts(newer.unionByName(newer.filter(F.col("device") % 2 == 0))), landing)
        # With a narrow bound each arrival is one batch, so that only the second is late.
        files = None if bound == NARROW else FILES_PER_BATCH
        start(jobs.read_feed(spark, landing, files_per_batch=files), path, checkpoint).awaitTermination()
        _land(_texts(facts.filter(F.col(TIME) < moment(FEED_FROM))), landing)
        start(jobs.read_feed(spark, landing, files_per_batch=files), path, checkpoint).awaitTermination()
        _STATEFUL[key] = path
    return _STATEFUL[key]


def _deduped(spark, sf, bound: timedelta) -> str:
    def start(feed, path, checkpoint):
        return stateful.stream_dedupe(feed, path, checkpoint, AS_OF, bound)

    return _stateful(spark, sf, "bounded", bound, start)


def _windowed(spark, sf, name: str) -> str:
    def start(feed, path, checkpoint):
        return stateful.stream_windows(feed, path, checkpoint, name, AS_OF, WIDE)

    return _stateful(spark, sf, f"windows-{name}", WIDE, start)


@query("stream_dedupe_bounded", sql_with("SELECT * FROM m", "m"))
def stream_dedupe_bounded(spark, sf):
    """Every reading once, by the keys in the state store; all are within the bound."""
    return stateful.facts(spark, _deduped(spark, sf, WIDE)).select(*MEASUREMENT_COLUMNS)


@query("stream_dedupe_late", sql_with(f"SELECT * FROM m WHERE when_captured < {ts(FEED_FROM)}", "m"))
def stream_dedupe_late(spark, sf):
    """Readings that came later than the bound, set aside with their values."""
    return stateful.late_readings(spark, _deduped(spark, sf, NARROW))


@query(
    "stream_set_aside",
    sql_with(
        f"SELECT 'late' AS kind, COUNT(*) AS rows FROM m WHERE when_captured < {ts(FEED_FROM)}"
        " UNION ALL SELECT 'future', 1 UNION ALL SELECT 'keyless', 1 UNION ALL SELECT 'torn', 2",
        "m",
    ),
)
def stream_set_aside(spark, sf):
    """How many rows became no facts, and why."""
    aside = stateful.set_aside(spark, _deduped(spark, sf, NARROW))
    return aside.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_windows_hourly", sql_with("SELECT * FROM h", "h"))
def stream_windows_hourly(spark, sf):
    """Hourly windows of event time, aggregated in the state store and merged by window."""
    return stateful.read_windows(spark, _windowed(spark, sf, "hour"), "hour")


@query("stream_windows_daily", sql_with("SELECT * FROM d", "d"))
def stream_windows_daily(spark, sf):
    return stateful.read_windows(spark, _windowed(spark, sf, "day"), "day")


@query(
    "stream_newest",
    sql_with(
        "SELECT DISTINCT ON (device_urn) device_urn, device_sn, loc_country, loc_name, loc_lat,"
        " loc_lon, lnd_7318u AS radiation, when_captured AS last_reading FROM m"
        " ORDER BY device_urn, when_captured DESC",
        "m",
    ),
)
def stream_newest(spark, sf):
    """One state per device, whatever the order of arrival."""
    path = _stateful(
        spark, sf, "newest", None, lambda feed, path, cp: stateful.stream_newest(feed, path, cp, AS_OF)
    )
    return stateful.read_newest(spark, path)


@query("stream_torn_lines", "SELECT 'torn' AS reason, CAST(2 AS BIGINT) AS rows UNION ALL SELECT 'keyless', 1 UNION ALL SELECT 'future', 1")
def stream_torn_lines(spark, sf):
    """What the exact stream set aside of a feed with lines that do not parse; none became a reading."""
    root, checkpoint, landing = (scratch_path(spark, part) for part in ("torn", "checkpoint", "landing"))
    facts = measurements(spark, sf)
    _with_defects(spark, facts, landing)
    _land(_texts(facts), landing)
    jobs.stream_publish(_stream(spark, landing), root, checkpoint, lambda: AS_OF).awaitTermination()
    lake = TelemetryTables(spark, root)
    if lake.facts().count() != facts.count():
        raise AssertionError("a torn line became a reading")
    return lake.quarantine().groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
