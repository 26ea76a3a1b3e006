"""One key with a third of the rows: same results, no group gathered."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sensorspan.operators.dedupe import first_per_key, insert_or_ignore
from sensorspan.operators.joins import device_radiation_stats, join_device_stats
from sensorspan.plans.panels import anomalies_zscore

from .feeds import rows_of


@pytest.fixture(scope="module")
def facts(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot:1").otherwise(F.concat(F.lit("d:"), F.col("id") % 50))
    return spark.range(6000).select(
        hot.alias("device_urn"),
        F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-05").cast("timestamp_ntz")).alias(
            "when_captured"
        ),
        (F.col("id") * 7919 % 101).alias("lnd_7318u"),
    )


def test_shuffled_and_broadcast_joins_agree(spark, facts):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    stats = device_radiation_stats(facts)
    few = rows_of(join_device_stats(facts, stats))
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        joined = join_device_stats(facts, stats)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        many = rows_of(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert few == many
    assert len(few) == facts.count()


def test_anomalies_against_brute_force(facts):
    data = [tuple(r) for r in facts.collect()]
    groups = {}
    for urn, _, value in data:
        if value > 0:
            groups.setdefault(urn, []).append(value)
    stats = {}
    for urn, values in groups.items():
        mean = sum(values) / len(values)
        stats[urn] = mean, (sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5
    frm, to = "2024-01-05 00:10:00", "2024-01-05 01:00:00"
    want = sorted(
        (str(t), urn, v)
        for urn, t, v in data
        if frm <= str(t) <= to and (v - stats[urn][0]) / stats[urn][1] > 1.5
    )
    got = anomalies_zscore(facts, frm, to, threshold=1.5).collect()
    assert sorted((str(r.when_captured), r.device_urn, r.lnd_7318u) for r in got) == want


def test_constant_and_single_readings_are_no_anomalies(spark):
    rows = spark.createDataFrame(
        [("a", 5, 1), ("a", 5, 2), ("b", 9, 3)], "device_urn string, lnd_7318u bigint, s int"
    ).withColumn(
        "when_captured",
        F.timestamp_add("SECOND", F.col("s"), F.lit("2024-01-05").cast("timestamp_ntz")),
    )
    assert anomalies_zscore(rows, "2024-01-01", "2024-02-01", threshold=-10).count() == 0


def test_many_copies_of_one_key_combine_before_the_shuffle(spark):
    copies = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("device"),
        F.lit("2024-01-05").cast("timestamp_ntz").alias("when_captured"),
        F.col("id").alias("pos"),
    )
    first = first_per_key(copies, ["device", "when_captured"], ["pos"])
    assert first.count() == 20_001
    assert first.filter("device = -1").first().pos == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert "Window" not in plan
    held = first.filter("device >= 0").drop("pos")
    assert rows_of(insert_or_ignore(copies, held, ["pos"]), "device", "pos") == [(-1, 0)]
