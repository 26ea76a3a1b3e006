from __future__ import annotations

import pytest

from sensorspan.config import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        master="local[8]",
        app="sensorspan-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "tables")
