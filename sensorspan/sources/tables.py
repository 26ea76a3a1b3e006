"""Parquet tables and the session catalog."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import row_counts


def scan_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_full(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def copy_tables(spark: SparkSession, source: str, dest: str, names: Iterable[str]) -> None:
    """Replace each table under ``dest`` by the one under ``source``."""
    for name in names:
        spark.read.parquet(f"{source}/{name}").write.mode("overwrite").parquet(f"{dest}/{name}")


def table_catalog(spark: SparkSession) -> DataFrame:
    """The session's tables and views with their row counts."""
    names = [t.name for t in spark.catalog.listTables()]
    if not names:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return row_counts({name: spark.table(name) for name in names})


def ensure_tables(
    spark: SparkSession,
    build: Mapping[str, Callable[[], DataFrame]],
    refresh: Callable[[], None] | None = None,
) -> bool:
    """Build all tables unless all exist, else refresh. True when built."""
    if all(spark.catalog.tableExists(name) for name in build):
        if refresh is not None:
            refresh()
        return False
    for name, make in build.items():
        make().write.mode("overwrite").saveAsTable(name)
    return True


def column_statistics(df: DataFrame, ranged: Sequence[str]) -> DataFrame:
    """One row per column: its nulls and, for the ``ranged`` ones, its extremes, by one aggregation."""
    whole = []
    for name in df.columns:
        low, high = (f(name).cast("string") if name in ranged else F.lit(None).cast("string") for f in (F.min, F.max))
        nulls = F.count_if(F.col(name).isNull()).cast("string")
        whole.append(
            F.struct(F.lit(name).alias("col_name"), nulls.alias("num_nulls"), low.alias("min"), high.alias("max"))
        )
    return df.agg(F.array(*whole).alias("columns")).select(F.inline("columns"))
