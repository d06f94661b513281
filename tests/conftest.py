import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="run-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tablesync-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", f"{root}/shared")
        .config("spark.sql.warehouse.dir", f"{root}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def new_dir(spark):
    from tablesync.sinks.files import new_path

    return new_path(spark, "test")


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.fixture
def derby(spark):
    """Options of an in-process database that lives as long as the session's JVM."""
    return {
        "url": f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
        "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    }


def rows(df):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
