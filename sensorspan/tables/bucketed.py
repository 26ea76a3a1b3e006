"""Facts in buckets of their key, so that a batch is matched against them where they lie.

Both parts of the key are hashed: a device with most readings is in all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timebuckets import day_of
from ..operators.dedupe import first_per_key
from ..operators.filters import TIME, all_present
from ..schema import FACT_KEY

BUCKETS = 64


class BucketedFacts:
    """A catalog table of facts by day and, inside a day, by hash buckets of (device, time).

    Joins on the whole key read the held side as it lies: only the batch is shuffled,
    into as many partitions as there are buckets.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.name = name
        self.path = path
        self.buckets = buckets

    def append(self, rows: DataFrame) -> None:
        """Add rows; the caller has left out those that are held."""
        named = rows.withColumn("day", day_of(TIME))
        # One task writes one bucket, of all days, so that a day has a file for each bucket.
        (
            named.repartition(self.buckets, *FACT_KEY)
            .write.mode("append")
            .partitionBy("day")
            .bucketBy(self.buckets, *FACT_KEY)
            .sortBy(*FACT_KEY)
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def facts(self) -> DataFrame:
        return self.spark.table(self.name)

    def unmatched(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key is not held. Only the batch's days are read, and only its rows move.

        Rows without the whole key match nothing and stay.
        """
        if not self.spark.catalog.tableExists(self.name):
            return batch
        days = [r[0] for r in batch.select(day_of(TIME)).distinct().collect() if r[0] is not None]
        held = self.facts().filter(F.col("day").isin(days)).select(*FACT_KEY)
        complete = all_present(FACT_KEY)
        fresh = batch.filter(complete).join(held, list(FACT_KEY), "left_anti")
        return fresh.select(*batch.columns).union(batch.filter(~complete))

    def insert_or_ignore(self, batch: DataFrame, order: Sequence[Column | str]) -> None:
        """Append the first row of each key of the batch, by ``order``, unless it is held; rows without a key are left out."""
        first = first_per_key(batch.filter(all_present(FACT_KEY)), FACT_KEY, order)
        self.append(self.unmatched(first))
