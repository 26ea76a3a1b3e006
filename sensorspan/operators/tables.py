"""Table-level operators: state, retention, footers, unions, comparison."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timebuckets import EPOCH, moment
from .filters import TIME, last


def last_sync(state: DataFrame, table: str) -> DataFrame:
    """One row: when ``table`` was last synced, the epoch if never."""
    known = state.filter(F.col("table_name") == table)
    newest = F.max("last_sync_timestamp")
    return known.agg(F.coalesce(newest, moment(EPOCH)).alias("last_ts"))


def next_sync(facts: DataFrame, as_of: datetime, table: str = "measurements") -> DataFrame:
    """The watermark to store: the newest capture that is not in the future."""
    return facts.filter(F.col(TIME) <= moment(as_of)).agg(
        F.lit(table).alias("table_name"), F.max(TIME).alias("last_sync_timestamp")
    )


def retain(df: DataFrame, as_of: datetime, days: int, column: str = TIME) -> DataFrame:
    return last(df, as_of, column=column, days=days)


def purge_future(df: DataFrame, as_of: datetime) -> DataFrame:
    limit = moment(as_of + timedelta(days=1))
    return df.filter(~(F.col(TIME) > limit))


def organize(df: DataFrame, order: Mapping[str, int], hidden: set[str]) -> DataFrame:
    """Columns by their index, without the hidden ones."""
    shown = [name for name in sorted(order, key=order.get) if name not in hidden]
    return df.select(*shown)


def footer_sum(df: DataFrame) -> DataFrame:
    """One row with the sum of every numeric column, added up as doubles."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.agg(*[F.sum(F.col(name).cast("double")).alias(name) for name in numeric])


def table_span(df: DataFrame, name: str, column: str) -> DataFrame:
    ts = F.col(column).cast("timestamp_ntz")
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        *(
            df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            for name, df in tables.items()
        )
    )


def empty_clone(df: DataFrame) -> DataFrame:
    """No rows of the same schema; the planner drops the scan."""
    return df.limit(0)


def empty_relation(spark: SparkSession, schema: T.StructType) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free checksum over all columns."""
    columns = [F.col(name) for name in sorted(df.columns)]
    digest = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("checksum"))


def roundtrip_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whether two copies of a table agree, by count and checksum."""
    copy = fingerprint(after).select(F.struct("rows", "checksum")).scalar()
    return fingerprint(before).select(
        F.col("rows").alias("rows_before"),
        copy["rows"].alias("rows_after"),
        (F.col("rows") == copy["rows"]).alias("same_count"),
        F.col("checksum").eqNullSafe(copy["checksum"]).alias("same_content"),
    )


def batch_report(
    fetched: DataFrame, valid: DataFrame, new: DataFrame, total: DataFrame, state: DataFrame
) -> DataFrame:
    """One row per load: how many rows came, were valid, were new, are held now."""
    count = F.count(F.lit(1))
    return state.select(
        fetched.agg(count).scalar().alias("fetched"),
        valid.agg(count).scalar().alias("valid"),
        new.agg(count).scalar().alias("new"),
        total.agg(count).scalar().alias("total"),
        F.col("last_ts").alias("old_watermark"),
        total.agg(F.max(TIME)).scalar().alias("new_watermark"),
    )
