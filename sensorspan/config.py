"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"

# Keyed state of streams lives on the executors' disks, not on their heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Java compiles no method of more than 8,000 bytes. Casts and checks of a whole reading in one generated method are
# longer than that and stay interpreted; with this limit Spark gives each expression a method of its own instead.
SHORT_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def session(app: str = "sensorspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the queries expect.

    Timestamps are zone-less throughout, so UTC only matters where a stream
    has to carry them as instants. AQE picks the number of reduce partitions,
    splits skewed ones and turns joins into broadcasts by measured size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **changed: str) -> Iterator[None]:
    """What is planned, and streams that are started, in here have these settings; the session keeps its own."""
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    That is the checkpoint folder, or the warehouse of a session without one.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get(WAREHOUSE_CONF)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/sensorspan/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The result survives the loss of executors, has no upstream lineage, and
    its size is known to the planner from the files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
