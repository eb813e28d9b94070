"""Choosing the files of a replica that can hold changes."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from checks import queries
from checks.queries import ORACLES, QUERIES
from checks.standin import given
from tests import tiny
from tests.conftest import rows
from tidemark import VNM, generic_region, sync_catalog
from tidemark.operators.changes import changed_since
from tidemark.plans import tracks
from tidemark.plans.context import Run
from tidemark.schemas import SOURCES
from tidemark.sources.catalog import Replicas, load_sources
from tidemark.sources.file_dates import FileDates
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.staging import shared_folder

NAME = "tbm_albumstyle"
SCHEMA = SOURCES[NAME]
DAY = datetime(2024, 1, 1)


def folder(spark) -> str:
    return f"{shared_folder(spark)}/dates a%20b-{uuid.uuid4().hex}"


def styles(spark, ids, date):
    return spark.createDataFrame([(i, 1, 0, date) for i in ids], SCHEMA)


def add(spark, root, ids, date):
    styles(spark, ids, date).coalesce(1).write.mode("append").parquet(f"{root}/{NAME}")


def since(spark, root, dates_root, cut):
    src = load_sources(spark, root, names=[NAME], dates_root=dates_root)
    found = src.since(NAME, cut)
    return found, [r.album_id for r in changed_since(found, cut, ("crt_dt",)).orderBy("album_id").collect()]


def test_only_files_with_later_dates_are_read(spark):
    root, dates_root = folder(spark), folder(spark)
    for day in range(5):
        add(spark, root, [10 * day, 10 * day + 1], DAY + timedelta(days=day))
    add(spark, root, [100], None)
    add(spark, root, [], DAY)
    found, ids = since(spark, root, dates_root, DAY + timedelta(days=3))
    assert ids == [40, 41] and len(found.inputFiles()) == 1
    assert found.schema == load_sources(spark, root, names=[NAME])[NAME].schema
    found, ids = since(spark, root, dates_root, DAY + timedelta(days=2))
    assert ids == [30, 31, 40, 41] and len(found.inputFiles()) == 2
    found, ids = since(spark, root, dates_root, DAY + timedelta(days=9))
    assert ids == [] and found.count() == 0


def test_all_files_are_the_table_itself(spark):
    root, dates_root = folder(spark), folder(spark)
    add(spark, root, [1], DAY)
    src = load_sources(spark, root, names=[NAME, ], dates_root=dates_root)
    assert isinstance(src, Replicas) and src.since(NAME, DAY - timedelta(days=1)) is src[NAME]


def test_only_new_and_replaced_files_are_read_for_their_dates(spark):
    root, dates_root = folder(spark), folder(spark)
    path = f"{root}/{NAME}"
    for day in range(3):
        add(spark, root, [day], DAY + timedelta(days=day))
    dates = FileDates(spark, dates_root)
    assert dates.refresh(NAME, path, SCHEMA) == 3
    assert dates.refresh(NAME, path, SCHEMA) == 0
    add(spark, root, [7], DAY + timedelta(days=7))
    assert dates.refresh(NAME, path, SCHEMA) == 1
    cut = DAY + timedelta(days=6)
    assert since(spark, root, dates_root, cut)[1] == [7]
    # an old file gets other rows under its name
    old = sorted(p for p in Path(path).glob("*.parquet") if changed_since(spark.read.parquet(f"file:{p}"), DAY, ("crt_dt",)).count() == 0)[0]
    other = folder(spark)
    styles(spark, [8, 9], DAY + timedelta(days=8)).coalesce(1).write.parquet(other)
    old.write_bytes(next(Path(other).glob("*.parquet")).read_bytes())
    for crc in old.parent.glob(f".{old.name}.crc"):
        crc.unlink()
    assert dates.refresh(NAME, path, SCHEMA) == 1
    assert since(spark, root, dates_root, cut)[1] == [7, 8, 9]


def test_a_file_that_is_gone_leaves_the_list(spark):
    root, dates_root = folder(spark), folder(spark)
    for day in range(3):
        add(spark, root, [day], DAY + timedelta(days=day))
    assert since(spark, root, dates_root, DAY)[1] == [1, 2]
    gone = next(p for p in Path(root, NAME).glob("*.parquet") if spark.read.parquet(f"file:{p}").first().album_id == 2)
    gone.unlink()
    assert since(spark, root, dates_root, DAY)[1] == [1]


def test_lists_are_few_and_unfinished_ones_are_not_read(spark):
    root, dates_root = folder(spark), folder(spark)
    for day in range(6):
        add(spark, root, [day], DAY + timedelta(days=day))
        dead = Path(dates_root, NAME, f"{day + 1:010d}-zz")
        dead.mkdir(parents=True)
        assert since(spark, root, dates_root, DAY + timedelta(days=day - 1))[1] == [day]
    assert len([p for p in Path(dates_root, NAME).iterdir() if Path(p, "_SUCCESS").exists()]) == 3
    assert len(list(Path(dates_root, NAME).iterdir())) <= 6


def test_an_empty_replica(spark):
    root, dates_root = folder(spark), folder(spark)
    add(spark, root, [], DAY)
    assert since(spark, root, dates_root, DAY)[1] == []


@pytest.mark.parametrize("region", [VNM, generic_region()], ids=["regional", "generic"])
def test_a_sync_by_files_gives_the_same_tables(spark, region):
    src, tgt = tiny.catalogue(21)
    root, got = folder(spark), []
    for name, df in tiny.frames(spark, src).items():
        df.repartition(3).write.parquet(f"{root}/{name}")
    for dates_root in (None, folder(spark)):
        store = Snapshots(spark, folder(spark))
        store.seed(tiny.frames(spark, tgt))
        loaded = load_sources(spark, root, dates_root=dates_root)
        tables = sync_catalog(spark, loaded, store, region, tiny.AS_OF)
        got.append({name: rows(df) for name, df in tables.items()})
    assert got[0] == got[1]


def test_the_scans_for_changed_tracks_open_few_files(spark, monkeypatch):
    """The whole tables are read for their keys alone, past the ids that the few files gave."""
    lines = given(spark, "/root/testdata/sf0.001", "lineitem")
    root, dates_root = folder(spark), folder(spark)
    names = ["ted_track", "ted_track_w", "ted_trackartist"]
    for name in names:
        fields = [f"{'cast(null as ' + f.dataType.simpleString() + ')'} as {f.name}" for f in SOURCES[name].fields]
        df = lines.selectExpr("l_orderkey", "l_shipdate", *fields).withColumn("track_id", lines.l_orderkey)
        df = df.withColumn("upd_dt", lines.l_shipdate.cast("timestamp_ntz")).drop("l_orderkey", "l_shipdate")
        df.repartitionByRange(10, "upd_dt").write.parquet(f"{root}/{name}")
    src = load_sources(spark, root, names=names, dates_root=dates_root)
    latest = lines.selectExpr("max(cast(l_shipdate as timestamp_ntz))").first()[0]
    run = Run.start(spark, VNM, latest)
    opened = {n: len(run.recent(src, n).inputFiles()) for n in names}
    assert opened == dict.fromkeys(names, 1)
    assert all(len(src[n].inputFiles()) == 10 for n in names)
    seen = []
    monkeypatch.setattr(tracks, "changed_ids", lambda *args: seen.append(args) or args[0].select("track_id"))
    tracks.changed_tracks(src, run)
    region, assoc, base, recent = seen[0][0], seen[0][1], seen[0][2], seen[0][6]
    assert [len(df.inputFiles()) for df in (region, assoc, base, *recent)] == [10, 10, 1, 1, 1]


def test_queries_are_registered():
    assert {"changed_since_by_files", "changed_tracks_by_files"} <= set(QUERIES) & set(ORACLES)


def test_a_date_of_many_rows_goes_to_several_files(spark, monkeypatch):
    monkeypatch.setattr(queries, "_FILE_ROWS", 100, raising=False)
    rows_of = [(i, "VNM", "t", "a", None, DAY, None, "A") for i in range(4000)] + [(i, "JPN", "t", "a", None, None, None, "A") for i in range(9)]
    monkeypatch.setattr(queries, "standin", lambda spark, sf, name: spark.createDataFrame(rows_of, SOURCES[name]))
    found = queries._by_files(spark, "", ["ted_track_w"])["ted_track_w"]
    sizes = [r["count"] for r in found.groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == len(rows_of) and max(sizes) < 400
    assert rows(found) == sorted(rows_of, key=repr)


def test_dates_are_read_in_tasks_of_the_usual_size(spark):
    root, dates_root = folder(spark), folder(spark)
    for day in range(12):
        add(spark, root, [day], DAY + timedelta(days=day))
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    group = uuid.uuid4().hex
    try:
        for name, value in zip(before, ("1k", "1k"), strict=True):
            spark.conf.set(name, value)
        spark.sparkContext.setJobGroup(group, "dates")
        FileDates(spark, dates_root).refresh(NAME, f"{root}/{NAME}", SCHEMA)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(tasks_of(spark, group)) >= 12


def tasks_of(spark, group):
    """Numbers of tasks of a group's stages."""
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = [tracker.getStageInfo(s) for job in jobs if job for s in job.stageIds]
    return [s.numTasks for s in stages if s]
