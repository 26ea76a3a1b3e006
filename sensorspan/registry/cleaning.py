"""Cleaning and typing of a raw feed.

The oracle works on the same raw text. DuckDB rounds doubles and text
differently when casting to whole numbers, so feed numbers are cast to DOUBLE
first and the text id is cast as text, as in the table's own load.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import cleaning as cl
from ..functions.casting import number_to_bigint, to_bigint, to_moment
from ..functions.timebuckets import moment
from ..operators.dedupe import split_keyed, unique_by_first, unmatched
from ..operators.tables import batch_report, last_sync
from ..plans.ingest import clean_feed, enforce_schema, ingest, valid_time
from .core import AS_OF, HELD_UNTIL, measurements, query, raw_feed, sql_with, ts

BATCH_TIME = datetime(2024, 1, 30, 12, 0, 5)
STAMP = BATCH_TIME.strftime("%Y-%m-%d %H:%M:%S")

FIRST = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER"
    " (PARTITION BY device_urn, when_captured ORDER BY pos) AS rn FROM f) WHERE rn = 1"
)


def _number(name: str) -> str:
    return f"CASE WHEN {name} IS NULL OR {name} = '' THEN '0' ELSE {name} END AS {name}"


def _text(name: str) -> str:
    return f"COALESCE({name}, '0') AS {name}"


FILENAME = (
    "CASE WHEN device_urn IS NOT NULL AND device_urn != '' AND device_urn != '0'"
    " THEN replace(replace(device_urn, ':', '_'), '\"', '_') || '.json'"
    " ELSE 'unknown_device.json' END AS device_filename"
)
CLEANED = (
    f"SELECT CASE WHEN when_captured IS NULL OR when_captured = '' THEN '{STAMP}'"
    " ELSE when_captured END AS when_captured, "
    + ", ".join(
        [_text(c) for c in ("device_urn", "device_sn", "device", "loc_name", "loc_country")]
        + [_text(c) for c in ("lnd_7318c", "lnd_7128ec", "pms_pm02_5")]
        + [_number(c) for c in ("loc_lat", "loc_lon", "env_temp", "lnd_7318u")]
        + [_number(c) for c in ("bat_voltage", "dev_temp")]
        + [FILENAME]
    )
    + " FROM u"
)


def _whole(name: str) -> str:
    return f"TRY_CAST(TRY_CAST({name} AS DOUBLE) AS BIGINT) AS {name}"


TYPED = (
    f"SELECT bat_voltage, {_whole('dev_temp')}, TRY_CAST(device AS BIGINT) AS device, device_sn,"
    f" device_urn, device_filename, {_whole('env_temp')}, lnd_7128ec, lnd_7318c,"
    f" {_whole('lnd_7318u')}, loc_country, TRY_CAST(loc_lat AS DOUBLE) AS loc_lat,"
    " TRY_CAST(loc_lon AS DOUBLE) AS loc_lon, loc_name, pms_pm02_5,"
    " TRY_CAST(when_captured AS TIMESTAMP) AS when_captured FROM c"
)
VALID = "SELECT * FROM t WHERE when_captured IS NOT NULL"


def _clean_sql(body: str, upto: str = "c") -> str:
    stages = {"u": FIRST, "c": CLEANED, "t": TYPED, "v": VALID}
    names = list(stages)[: list(stages).index(upto) + 1]
    return sql_with(body, "f", **{name: stages[name] for name in names})


def _first(spark, sf):
    return unique_by_first(raw_feed(spark, sf))


@query("clean_feed", _clean_sql("SELECT * FROM c"))
def clean_feed_query(spark, sf):
    return clean_feed(_first(spark, sf), BATCH_TIME)


@query("enforce_schema", _clean_sql("SELECT * FROM t", "t"))
def enforce_schema_query(spark, sf):
    return enforce_schema(clean_feed(_first(spark, sf), BATCH_TIME))


@query("filter_valid_ts", _clean_sql("SELECT * FROM v", "v"))
def filter_valid_ts(spark, sf):
    return valid_time(enforce_schema_query(spark, sf))


@query("ingest_feed", _clean_sql("SELECT * FROM v", "v"))
def ingest_feed(spark, sf):
    return ingest(raw_feed(spark, sf), BATCH_TIME).drop("pos")


_FIT = "device IS NOT NULL AND when_captured <= TIMESTAMP '2024-02-01'"


@query(
    "quarantine_split",
    _clean_sql(
        f"SELECT *, CASE WHEN {_FIT} THEN 'fit' ELSE 'quarantined' END AS verdict FROM v", "v"
    ),
)
def quarantine_split(spark, sf):
    fit, unfit = split_keyed(ingest_feed(spark, sf), AS_OF)
    return fit.withColumn("verdict", F.lit("fit")).unionByName(
        unfit.withColumn("verdict", F.lit("quarantined"))
    )


_HELD = f"SELECT * FROM m WHERE when_captured < {ts(HELD_UNTIL)}"


@query(
    "batch_report_feed",
    sql_with(
        "SELECT (SELECT COUNT(*) FROM f) AS fetched, (SELECT COUNT(*) FROM v) AS valid,"
        " (SELECT COUNT(*) FROM fresh) AS new,"
        " (SELECT COUNT(*) FROM held) + (SELECT COUNT(*) FROM fresh) AS total,"
        " (SELECT MAX(when_captured) FROM held) AS old_watermark,"
        " (SELECT MAX(when_captured) FROM (SELECT when_captured FROM held UNION ALL"
        " SELECT when_captured FROM fresh)) AS new_watermark",
        "f",
        "m",
        u=FIRST,
        c=CLEANED,
        t=TYPED,
        v=VALID,
        held=_HELD,
        fresh=(
            f"SELECT * FROM v WHERE {_FIT} AND NOT EXISTS (SELECT 1 FROM held"
            " WHERE held.device = v.device AND held.when_captured = v.when_captured)"
        ),
    ),
)
def batch_report_feed(spark, sf):
    """The report of a feed with every defect: repeats, times that are none, no device, the future."""
    feed = raw_feed(spark, sf)
    valid = ingest(feed, BATCH_TIME).drop("pos")
    held = measurements(spark, sf).filter(F.col("when_captured") < moment(HELD_UNTIL))
    fresh = unmatched(split_keyed(valid, AS_OF)[0], held)
    state = held.agg(F.lit("measurements").alias("table_name"), F.max("when_captured").alias("last_sync_timestamp"))
    return batch_report(feed, valid, fresh, held.unionByName(fresh), last_sync(state, "measurements"))


def _scalar(name: str, column: str, sql: str, make) -> None:
    @query(name, sql_with(f"SELECT pos, {column} AS raw, {sql} AS clean FROM f", "f"))
    def run(spark, sf):
        feed = raw_feed(spark, sf)
        return feed.select("pos", F.col(column).alias("raw"), make(F.col(column)).alias("clean"))


_scalar(
    "fill_timestamp",
    "when_captured",
    f"CASE WHEN when_captured IS NULL OR when_captured = '' THEN '{STAMP}' ELSE when_captured END",
    lambda c: cl.fill_timestamp(c, BATCH_TIME),
)
_scalar("default_string", "loc_country", "COALESCE(loc_country, '0')", cl.default_string)
_scalar(
    "default_number",
    "loc_lat",
    "CASE WHEN loc_lat IS NULL OR loc_lat = '' THEN '0' ELSE loc_lat END",
    cl.default_number,
)
_scalar(
    "derive_filename",
    "device_urn",
    FILENAME.removesuffix(" AS device_filename"),
    cl.derive_filename,
)
_scalar(
    "coalesce",
    "device_sn",
    "COALESCE(device_sn, 'none')",
    lambda c: F.coalesce(c, F.lit("none")),
)
_scalar("cast_bigint_text", "device", "TRY_CAST(device AS BIGINT)", to_bigint)
_scalar(
    "cast_bigint_number",
    "env_temp",
    "TRY_CAST(TRY_CAST(env_temp AS DOUBLE) AS BIGINT)",
    number_to_bigint,
)
_scalar("cast_timestamp", "when_captured", "TRY_CAST(when_captured AS TIMESTAMP)", to_moment)
