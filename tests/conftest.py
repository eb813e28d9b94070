from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "100000")  # whole paths in plan tests
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemark-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as for tables beyond the broadcast threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
