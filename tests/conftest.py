"""One local session for all tests, in UTC, with few partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from eventmart.session import configured


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configured(session)
    session.stop()
