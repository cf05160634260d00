import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from minutefold.config import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("minutefold-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
