"""What passes through the driver: tasks that list folders, and tables that are broadcast in a run."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_file_dates import tasks_of
from tidemark import VNM
from tidemark.plans import runner
from tidemark.schemas import TARGETS
from tidemark.sources.settings import broadcasts_of, number_of_bytes
from tidemark.sources.sinks import fill_columns
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.staging import shared_folder

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def store_of(spark, parts):
    store = Snapshots(spark, f"{shared_folder(spark)}/settings-{uuid.uuid4().hex}", 1)
    store.seed({"mv": fill_columns(spark.range(parts).select(F.col("id").alias("mv_id")), TARGETS["mv"])})
    return store


def test_many_parts_are_listed_in_few_tasks(spark):
    store, group = store_of(spark, 90), uuid.uuid4().hex
    folders = store.published()[1]
    assert len(folders) == 90
    try:
        spark.sparkContext.setJobGroup(group, "listing")
        found = store.read_table("mv", folders)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    counts = tasks_of(spark, group)
    assert counts and max(counts) <= 32
    assert found.count() == 90


@pytest.mark.parametrize(("session", "within"), [("10MB", 1 << 20), ("10485760b", 1 << 20), ("256k", 256 << 10), ("-1", -1)])
def test_a_run_broadcasts_small_tables_only(spark, session, within):
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, session)
    try:
        with runner._started(spark, store_of(spark, 1), VNM, datetime(2024, 1, 1), None, []):
            assert number_of_bytes(spark.conf.get(BROADCAST)) == within
        assert spark.conf.get(BROADCAST) == session
        with pytest.raises(KeyError), broadcasts_of(spark, 1 << 10):
            with broadcasts_of(spark, 1 << 10):
                pass
            assert number_of_bytes(spark.conf.get(BROADCAST)) == min(within, 1 << 10)  # until the last leaves
            raise KeyError
        assert spark.conf.get(BROADCAST) == session
    finally:
        spark.conf.set(BROADCAST, before)
