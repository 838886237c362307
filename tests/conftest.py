import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(df)`` as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def events_of(spark):
    """``events_of([(id, level, source, message, time, trace), ...])``"""

    def build(data):
        return spark.createDataFrame(
            data, "id bigint, level string, source string, message string, time string, trace_id string"
        ).selectExpr("id", "level", "source", "message", "cast(time as timestamp_ntz) as timestamp", "trace_id")

    return build
