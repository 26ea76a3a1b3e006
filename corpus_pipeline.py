"""From raw documents to shards: each stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspan.llm.common import saved, table
from sensorspan.llm.decontamination import without_items
from sensorspan.llm.jaccard import keep_one
from sensorspan.llm.language import keep_certain
from sensorspan.llm.mixing import mix
from sensorspan.llm.sharding import shard_documents

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHARDS = 40


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, in none of the labelled languages, and those whose language stays open, go."""
    return keep_certain(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays: similarity 0.8 or more over shingles of five words.

    Candidates are operator 1's links of close fingerprints and, for what these miss, shared MinHash keys.
    """
    return keep_one(docs.select(*COLUMNS), 0.8, 5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_items(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, from not at all to three times.

    Rows with the same id, which the stages before do not leave, are taken alike.
    """
    copies = mix(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies")).where("_copies > 0")
    rows = docs.select(*COLUMNS)
    taken = rows.join(copies, rows["doc_id"].eqNullSafe(copies["_id"]))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and place of every document of the mix."""
    return shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Connected components and trained models have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each stage keeps is saved for the next."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs)
    return docs
