"""Duplicates, and what a new batch adds to rows already held.

No operator here gathers the copies of a key: winners are picked by an
aggregate that combines on the map side, so a key with very many copies
reaches the reducers as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timebuckets import moment
from ..schema import FACT_KEY, FEED_KEY
from .filters import all_present, last


def _winner(df: DataFrame, keys: Sequence[str], pick, order: Sequence[Column | str]) -> DataFrame:
    rest = [name for name in df.columns if name not in keys]
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the least ``order`` of every key; NULL keys form a group."""
    return _winner(df, keys, F.min_by, order)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the greatest ``order`` of every key."""
    return _winner(df, keys, F.max_by, order)


def unique_by_first(feed: DataFrame, position: str = "pos") -> DataFrame:
    """First object of every raw device and time, by its place in the feed."""
    return first_per_key(feed, FEED_KEY, [position])


def without(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``.

    A key with a NULL part matches nothing; such rows go around the join, or
    they would all meet in one partition of it. Copies of a key on the right
    combine before the shuffle.
    """
    known = right.select(*keys).distinct()
    complete = all_present(keys)
    return (
        left.filter(complete)
        .join(known, list(keys), "left_anti")
        .unionByName(left.filter(~complete))
    )


# Up to so many rows, a hash of each key is broadcast: at most some 100 MB.
FEW_ROWS = 2_000_000


def unmatched(
    batch: DataFrame,
    held: DataFrame,
    keys: Sequence[str] = FACT_KEY,
    few: bool = False,
) -> DataFrame:
    """Rows of ``batch`` whose key is not held, for a batch smaller than the table.

    Only held keys that occur in the batch matter. They are picked out first:
    the batch's keys are the build side there, so while they are small enough
    to be broadcast, the held rows are scanned but never shuffled. A batch of
    no more than ``FEW_ROWS`` rows (``few``) always broadcasts a hash of its keys; the
    few held keys that merely share one do no harm, whole keys are compared after that.
    """
    wanted = batch.select(*keys).filter(all_present(keys))
    if few:
        code = F.xxhash64(*keys).alias("_code")
        known = held.select(*keys, code).join(F.broadcast(wanted.select(code)), "_code", "left_semi").drop("_code")
    else:
        known = held.select(*keys).join(wanted.distinct(), list(keys), "left_semi")
    return without(batch, known, keys)


def unmatched_recent(
    batch: DataFrame,
    held: DataFrame,
    as_of: datetime,
    days: int = 7,
    keys: Sequence[str] = FACT_KEY,
) -> DataFrame:
    """``unmatched``, compared only with the last days of the held rows."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return unmatched(batch, last(held, midnight, days=days), keys)


def insert_or_ignore(
    batch: DataFrame,
    held: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str] = FACT_KEY,
    few: bool = False,
) -> DataFrame:
    """The rows to append: first of each key in the batch, unless it is held.

    Held keys go first, so that of a batch of repeats nothing is left to choose from.
    """
    return first_per_key(unmatched(batch, held, keys, few), keys, order)


def upsert(
    held: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Insert or replace by key. The last update of a key by ``order`` counts.

    Held rows are only matched against the updates' keys; they are neither
    sorted nor aggregated.
    """
    if order is not None:
        updates = newest_per_key(updates, keys, order)
    return without(held, updates, keys).unionByName(updates)


def merge_history(
    held: DataFrame,
    incoming: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = FEED_KEY,
) -> DataFrame:
    """Held rows, then incoming ones; the first of each key stays."""
    both = held.withColumn("_source", F.lit(0)).unionByName(incoming.withColumn("_source", F.lit(1)))
    return first_per_key(both, keys, ["_source", *order]).drop("_source")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def split_keyed(
    df: DataFrame, as_of: datetime, keys: Sequence[str] = FACT_KEY
) -> tuple[DataFrame, DataFrame]:
    """Rows fit for the fact table, and the rest.

    A row without its full key, or captured more than a day after ``as_of``,
    would never be deduplicated or would drag the watermark along.
    """
    fit = all_present(keys) & (F.col("when_captured") <= moment(as_of + timedelta(days=1)))
    fit = F.coalesce(fit, F.lit(False))
    return df.filter(fit), df.filter(~fit)
