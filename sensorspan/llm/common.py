"""What the operators share: reading tables, cutting lineage, words, ranks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# White space that separates words: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, without its lineage.

    The folder is the one that the session names; only a session without one
    (a test) gets a folder in its own warehouse. A lost executor costs the
    tasks that it ran, not what is saved.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get(CHECKPOINT_CONF, None)
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return df.checkpoint(eager=True)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def code_points(text: Column) -> Column:
    return F.char_length(F.coalesce(text, F.lit(""))).cast("long")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def drawn(key: Column, share: Column) -> Column:
    """Whether a row is in a sample of ``share`` of all rows, by a hash of ``key``.

    No row is compared with others, so nothing is gathered to draw a sample.
    """
    fine = 1 << 52
    return F.xxhash64(key, F.lit("sample")).bitwiseAND(F.lit(fine - 1)) < share * fine


def ranked(df: DataFrame, groups: Iterable[str], order: Iterable[str], name: str = "rank") -> DataFrame:
    """Number the rows of each group from 0 in ``order``, without gathering a group.

    Rows with equal ``order`` are numbered by where they lie in ``df``, which
    has to be saved. A group is cut by ``order`` and by the partitions of
    ``df``: rows are numbered inside these pieces, whose counts, a row for each
    piece, give the offsets. A piece is never larger than a partition of ``df``.
    """
    groups, order = list(groups), list(order)
    placed = df.withColumn("_at", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    keys = [*groups, *order]
    pieces = placed.groupBy(*keys, "_at").agg(F.count("*").alias("_n"))
    totals = pieces.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    first = _before("_total", groups, order)
    totals = totals.select(*(F.col(c).alias(f"_{c}") for c in keys), first.alias("_first"))
    pieces = pieces.withColumn("_later", _before("_n", keys, ["_at"]))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    pieces = pieces.join(totals, same).select(
        *(f"_{c}" for c in keys), F.col("_at").alias("_piece"), (F.col("_first") + F.col("_later")).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_at").orderBy("_row"))
    joined = placed.withColumn("_inside", inside).join(pieces, [*same, F.col("_at") == F.col("_piece")])
    return joined.select(*df.columns, (F.col("_offset") + F.col("_inside") - 1).cast("long").alias(name))


def numbered(df: DataFrame, groups: Iterable[str], order: Iterable[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 in ``order``, nulls first, wherever one group has most rows.

    All rows are dealt by ranges of group and order. A group that goes on in the next
    partition is numbered on from what the partitions before hold of it; there is at
    most one such group for each partition.
    """
    groups, order = list(groups), list(order)
    placed = saved(df.repartitionByRange(*groups, *order)).withColumn("_at", F.spark_partition_id())
    counts = placed.groupBy(*groups, "_at").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*(F.col(c).alias(f"_{c}") for c in groups), F.col("_at").alias("_piece"), earlier.alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*groups, "_at").orderBy(*order))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups]
    joined = placed.withColumn("_inside", inside).join(
        offsets.where("_offset is not null"), [*same, F.col("_at") == F.col("_piece")], "left"
    )
    return joined.select(*df.columns, (F.coalesce("_offset", F.lit(0)) + F.col("_inside") - 1).cast("long").alias(name))


def _before(value: str, groups: list[str], order: list[str]) -> Column:
    """The sum of ``value`` over the rows of the group that come before."""
    window = Window.partitionBy(*groups).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
