import os

import pytest
from pyspark.sql import SparkSession

from stampcard import tune

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("stampcard-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session, streaming=True)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
