import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortqc.session import with_defaults  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = with_defaults(
        SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
