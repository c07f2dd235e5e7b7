import os
import tempfile

import pytest
from pyspark.sql import SparkSession



@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="ferryline-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ferryline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def new_dir(tmp_path):
    """A fresh path for each call."""
    made = []

    def make(name="out"):
        made.append(name)
        return str(tmp_path / f"{name}-{len(made)}")

    return make
