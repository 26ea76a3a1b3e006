"""Row filters. Bounds are literals, so they are pushed into the scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timebuckets import as_datetime, moment

TIME = "when_captured"
PARTITION = "day"

# Fixed value: captures from this moment on are clock errors.
SANE_UPPER = "2030-01-01 00:00:00"


def _day_bounds(df: DataFrame, column: str, frm: datetime | None, to: datetime | None) -> DataFrame:
    """Repeat a time bound on the ``day`` partition, so whole days are skipped."""
    if PARTITION not in df.columns or column == PARTITION:
        return df
    if frm is not None:
        df = df.filter(F.col(PARTITION) >= F.lit(frm.date()))
    if to is not None:
        df = df.filter(F.col(PARTITION) <= F.lit(to.date()))
    return df


def last(df: DataFrame, as_of: datetime, column: str = TIME, **span: float) -> DataFrame:
    """Rows of the last ``span``, e.g. ``hours=24`` or ``days=7``."""
    since = as_datetime(as_of) - timedelta(**span)
    return _day_bounds(df, column, since, None).filter(F.col(column) >= moment(since))


def time_filter(
    df: DataFrame, frm: datetime | str, to: datetime | str, column: str = TIME
) -> DataFrame:
    """The dashboard's time range; both ends belong to it."""
    frm, to = as_datetime(frm), as_datetime(to)
    bounded = _day_bounds(df, column, frm, to)
    return bounded.filter(F.col(column).between(moment(frm), moment(to)))


def in_list(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows with one of the given values, which the scan can skip files by."""
    return df.filter(F.col(column).isin(list(dict.fromkeys(values))))


def in_relation(df: DataFrame, column: str, keys: DataFrame, key: str | None = None) -> DataFrame:
    """Rows with a value that ``keys`` has, however many those are.

    The keys are joined and never become part of the plan's text. Their least and
    greatest value are known before the scan starts and let it skip files and row groups.
    Null matches nothing.
    """
    key = key or column
    wanted = keys.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    low, high = (wanted.agg(edge("_key")).scalar() for edge in (F.min, F.max))
    return df.filter(F.col(column).between(low, high)).join(wanted, F.col(column) == F.col("_key"), "left_semi")


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def lookup(df: DataFrame, **criteria: object) -> DataFrame:
    """Only the given criteria apply, all of them.

    A list means any of its values, a DataFrame of one column any of its rows.
    """
    for column, wanted in criteria.items():
        if wanted is None:
            continue
        if isinstance(wanted, DataFrame):
            df = in_relation(df, column, wanted, wanted.columns[0])
        elif isinstance(wanted, (list, tuple, set)):
            df = in_list(df, column, wanted)
        else:
            df = equals(df, column, wanted)
    return df


def has_radiation() -> Column:
    return F.col("lnd_7318u") > 0


def has_air() -> Column:
    return F.col("pms_pm02_5") != "0"


def has_position() -> Column:
    return (F.col("loc_lat") != 0) & (F.col("loc_lon") != 0)


def sane_upper(df: DataFrame, column: str = TIME) -> DataFrame:
    return df.filter(F.col(column) < moment(SANE_UPPER))


def text_search(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.filter(F.contains(F.lower(F.col(column)), F.lit(needle.lower())))


def all_present(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in columns))


def after_watermark(df: DataFrame, state: DataFrame, column: str = TIME) -> DataFrame:
    """Rows strictly after the one value that ``state`` holds."""
    return df.filter(F.col(column) > state.scalar())


def from_newest_bucket(
    df: DataFrame, rollup: DataFrame, bucket: str, default: datetime | str, column: str = TIME
) -> DataFrame:
    """Rows from the rollup's newest bucket on, or from ``default`` when it is empty."""
    newest = rollup.agg(F.coalesce(F.max(F.col(bucket).cast("timestamp_ntz")), moment(default)))
    return df.filter(F.col(column) >= newest.scalar())
