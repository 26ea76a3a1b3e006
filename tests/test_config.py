"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

from sensorspan.config import CHECKPOINT_CONF, WAREHOUSE_CONF, materialise, shared_dir


def _session(**conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)))


def test_the_named_folder_is_used():
    named = {CHECKPOINT_CONF: "hdfs:///shared/", WAREHOUSE_CONF: "hdfs:///warehouse"}
    assert shared_dir(_session(**named)) == "hdfs:///shared"


def test_a_session_without_one_uses_its_warehouse():
    assert shared_dir(_session(**{WAREHOUSE_CONF: "hdfs:///warehouse"})) == "hdfs:///warehouse"


def test_materialised_rows_are_the_same_and_read_from_files(spark):
    df = materialise(spark.range(100).selectExpr("id", "id % 7 AS k"), "test")
    assert df.count() == 100
    assert len(df.inputFiles()) > 0
