from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from ledgerlens.session import DEFAULT_CONF


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="ledgerlens-tests-")
    builder = SparkSession.builder.master("local[8]").appName("ledgerlens-tests")
    conf = {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": f"{work}/warehouse",
        "spark.sql.streaming.stateStore.stateSchemaCheck": "true",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
