import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (SparkSession.builder.master("local[4]").appName("tradewell-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", str(shared / "checkpoints"))
               .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
