from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import tiny
from tests.conftest import rows
from tidemark import JPN, VNM, generic_region, sync_catalog, sync_rights
from tidemark.config import Region
from tidemark.plans.ddl_text import index_ddl_extract, reload_index_ddl
from tidemark.schemas import DDL_TEXT, INDEX_DDL, LOGIN_LOG, SOURCES, TARGETS
from tidemark.sources.catalog import jdbc_options, load_sources
from tidemark.sources.files import Files
from tidemark.sources.sinks import append_once, append_rows, ensure_batch_table, ensure_table, fill_columns, is_empty, truncate_reload
from tidemark.sources.snapshots import Snapshots, Version
from tidemark.sources.staging import Staging, shared_folder


def folder(spark):
    return f"{shared_folder(spark)}/test-{uuid.uuid4().hex}"


def new_table(spark, schema, **options):
    name = f"t_{uuid.uuid4().hex}"
    ensure_table(spark, name, schema, location=folder(spark), **options)
    return name


# --- regions


def test_region_ids():
    assert (VNM.agency_id, VNM.streaming, VNM.download, VNM.rental) == (19862, 715, 714, None)
    assert (JPN.agency_id, JPN.streaming, JPN.download, JPN.rental) == (20382, 716, 717, 718)
    assert VNM.services == (715, 714) and JPN.services == (716, 717, 718)


@pytest.mark.parametrize(("code", "agency"), [(None, 19862), ("VNM", 19862), ("JPN", None), ("KOR", None)])
def test_generic_region(code, agency):
    region = generic_region(code)
    assert (region.code, region.agency_id) == (code or "VNM", agency)
    assert region.services == (715, 714) and not region.regional


# --- sources


def test_load_sources_with_two_origins(spark):
    src, _ = tiny.catalogue(1)
    main, lyrics = folder(spark), folder(spark)
    for name, df in tiny.frames(spark, src).items():
        df.write.parquet(f"{lyrics if name.endswith('_lyrics') else main}/{name}")
    loaded = load_sources(spark, main, lyrics)
    assert set(loaded) == set(SOURCES)
    for name, df in loaded.items():
        assert df.schema == SOURCES[name]
        assert df.count() == len(src[name])


def test_jdbc_options_split_the_read():
    options = jdbc_options("jdbc:x:y", "ted_track", SOURCES["ted_track"], "track_id", 1, 1000, 64)
    assert options["partitionColumn"] == "track_id" and options["numPartitions"] == "64"
    assert "track_id bigint" in options["customSchema"] and "crt_dt timestamp_ntz" in options["customSchema"]


# --- staging


def test_staging_uses_the_shared_folder(spark):
    staged = Staging(spark)(spark.range(10).toDF("id"), "ids")
    assert all(f"{shared_folder(spark)}/tidemark-" in f for f in staged.inputFiles())
    assert rows(staged) == [(i,) for i in range(10)]


def test_staged_size_decides_the_join(spark):
    big = spark.range(1000).toDF("id")
    few = Staging(spark)(big.where("id % 100 = 0"), "few")
    plan = big.join(few, "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


# --- sinks


def test_append_fills_missing_columns(spark):
    name = new_table(spark, LOGIN_LOG)
    append_rows(spark.createDataFrame([(1, "W")], "msrl long, login_tp string"), name)
    append_rows(spark.createDataFrame([("odd", 2)], "m_exception string, msrl long"), name)
    got = rows(spark.table(name).select("msrl", "login_tp", "m_exception", "sso_srl"))
    assert got == [(1, "W", None, None), (2, None, "odd", None)]
    with pytest.raises(ValueError, match="nope"):
        append_rows(spark.createDataFrame([(1,)], "nope long"), name)


def test_ensure_table_keeps_an_existing_one(spark):
    name = new_table(spark, INDEX_DDL)
    append_rows(spark.createDataFrame([("a",)], INDEX_DDL), name)
    ensure_table(spark, name, INDEX_DDL)
    assert spark.table(name).count() == 1


def test_truncate_reload_creates_and_replaces(spark):
    name = f"t_{uuid.uuid4().hex}"
    for texts in (["a", "b"], ["c"], []):
        truncate_reload(spark.createDataFrame([(t,) for t in texts], INDEX_DDL), name, INDEX_DDL)
        assert [r[0] for r in rows(spark.table(name))] == texts
        assert is_empty(spark.table(name)) == (not texts)


def test_ensure_table_with_partitions(spark):
    name = new_table(spark, TARGETS["mv_local"], partition_by=["local_cd"])
    append_rows(spark.createDataFrame([(1, "VNM"), (2, "JPN")], "mv_id long, local_cd string"), name)
    assert rows(spark.table(name).where("local_cd = 'JPN'").select("mv_id")) == [(2,)]


def test_fill_columns_orders_and_types(spark):
    df = fill_columns(spark.createDataFrame([(5, "x")], "listorder int, nothing string").drop("nothing"), TARGETS["track_style"])
    assert df.schema.names == TARGETS["track_style"].names
    assert df.first()["listorder"] == 5


def test_index_ddl(spark):
    ddl = spark.createDataFrame(
        [("me", "i1", "CREATE INDEX A PCTFREE 10 PCTUSED 5"), ("me", "i2", "no marker"), ("you", "i3", "B PCT"),
         ("me", "i4", "PCT first"), ("me", "i5", None)],
        DDL_TEXT,
    )
    expected = [("CREATE INDEX A ",), (None,), (None,), (None,)]
    assert rows(index_ddl_extract(ddl, "me")) == sorted(expected, key=repr)
    name = f"t_{uuid.uuid4().hex}"
    for _ in range(2):
        reload_index_ddl(ddl, "me", name)
    assert rows(spark.table(name)) == sorted(expected, key=repr)


# --- snapshots


def seeded(spark, seed=3):
    src, tgt = tiny.catalogue(seed)
    store = Snapshots(spark, folder(spark))
    store.seed(tiny.frames(spark, tgt))
    return tiny.frames(spark, src), tgt, store


def test_empty_store_reads_as_empty_tables(spark):
    store = Snapshots(spark, folder(spark))
    assert store.published() == (0, {})
    assert all(df.count() == 0 for df in store.read({}).values())


def test_seed_and_read_back(spark):
    _, tgt, store = seeded(spark)
    run, folders = store.published()
    assert run == 1
    for name, want in tiny.as_rows(tgt).items():
        assert rows(store.read(folders)[name]) == want


def test_seed_refuses_rows_without_a_region(spark):
    store = Snapshots(spark, folder(spark))
    df = spark.createDataFrame([(1, None)], "mv_id long, local_cd string")
    with pytest.raises(ValueError, match="without a region"):
        store.seed({"mv_local": fill_columns(df, TARGETS["mv_local"])})


def mvs(spark, ids, title="old"):
    df = spark.createDataFrame([(i, title) for i in ids], "mv_id long, mv_title string")
    return fill_columns(df, TARGETS["mv"])


def test_scattered_ids_stay_in_few_parts(spark):
    store = Snapshots(spark, folder(spark), ids_per_part=10)
    ids = [None, -1, -(2**63), 2**63 - 1, *range(40), *[i * 7919 * 10**12 for i in range(1, 500)]]
    store.seed({"mv": mvs(spark, ids)})
    _, folders = store.published()
    numbers = {number for _, _, number in folders}
    assert {-1, 0, 1, 2, 3} < numbers and len(numbers) <= 1 + 4 + store.layout.buckets
    got = store.read_table("mv", folders).select("mv_id")
    assert sorted(rows(got), key=repr) == sorted([(i,) for i in ids], key=repr)
    # a changed id leads to the part that holds it
    for i in (None, -1, 12, 7919 * 10**12):
        parts = store.parts_of("mv", mvs(spark, [i]))
        held = store.read_table("mv", folders, parts).where(F.col("mv_id").eqNullSafe(F.lit(i)))
        assert held.count() == 1


def test_a_store_keeps_its_layout(spark):
    root = folder(spark)
    store = Snapshots(spark, root, ids_per_part=1_000_000)
    store.seed({"mv": mvs(spark, [5_000_000])})
    again = Snapshots(spark, root)
    assert again.layout == store.layout
    parts = again.parts_of("mv", mvs(spark, [5_000_000]))
    assert again.read_table("mv", again.published()[1], parts).count() == 1


@pytest.mark.parametrize("code", ["A:B", "a/b", "x=y", "50%", "a b", "[x]*?"])
def test_region_codes_that_folder_names_escape(spark, code):
    store = Snapshots(spark, folder(spark))
    df = spark.createDataFrame([(1, code), (2, "VNM")], "mv_id long, local_cd string")
    store.seed({"mv_local": fill_columns(df, TARGETS["mv_local"])})
    run, folders = store.published()
    assert {c for _, c, _ in folders} == {code, "VNM"}
    got = store.read_table("mv_local", folders).select("mv_id", "local_cd")
    assert rows(got) == sorted([(1, code), (2, "VNM")], key=repr)


def test_leftovers_of_failed_publishers_are_in_nobodys_way(spark):
    root = folder(spark)
    Path(root, "published/run=1").mkdir(parents=True)
    Path(root, "published/.run-0000000001.json.x").write_text('{"half":')
    store = Snapshots(spark, root)
    assert store.published() == (0, {})
    store.seed({"mv": mvs(spark, [1])})
    Path(root, "published/.run-0000000002.json.x").write_text("")
    store.seed({"mv": mvs(spark, [2])})
    run, folders = store.published()
    assert run == 2 and rows(store.read_table("mv", folders).select("mv_id")) == [(2,)]


def test_of_rival_publishers_one_wins(spark):
    root = folder(spark)
    Snapshots(spark, root).seed({"mv": mvs(spark, [1])})
    stores = [Snapshots(spark, root) for _ in range(8)]
    lists = [{**s.published()[1], ("mv", "", 100 + i): f"{root}/rival{i}"} for i, s in enumerate(stores)]

    def publish(i):
        try:
            stores[i].publish(lists[i], 2)
        except FileExistsError:
            return False
        return True

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(publish, range(8)))
    assert won.count(True) == 1
    assert Snapshots(spark, root).published() == (2, lists[won.index(True)])


def test_opening_a_store_starts_no_job(spark):
    store = Snapshots(spark, folder(spark))
    store.seed({"mv": mvs(spark, [1])})
    scheduler = spark._jsc.sc().dagScheduler()
    before = scheduler.numTotalJobs()
    Snapshots(spark, store._root).published()
    assert scheduler.numTotalJobs() == before


def test_remove_unused_keeps_what_a_kept_run_names(spark):
    root = folder(spark)
    store = Snapshots(spark, root, ids_per_part=10)
    store.seed({"mv": mvs(spark, [1, 11]), "track_style": fill_columns(spark.range(0).withColumnRenamed("id", "track_id"), TARGETS["track_style"])})
    for n in (2, 3, 4):
        run, folders = store.published()
        folders.update(store.write(mvs(spark, [1], f"v{n}"), "mv", store.new_version(run + 1)))
        store.publish(folders, run + 1)
    aborted = store.write(mvs(spark, [5]), "mv", store.new_version(5))
    store.remove_unused(keep_runs=2)
    assert sorted(store._runs()) == [3, 4]
    for path in store._runs().values():
        _, folders = store._list(path)
        assert store.read_table("mv", folders).count() == 2
    # of the first run only the part that later ones still name is left
    left = {str(p) for p in Path(root, "versions").glob("*/mv/part_no=*")}
    named = {p for path in store._runs().values() for p in store._list(path)[1].values()}
    assert {p.split("versions")[1] for p in left} == {p.split("versions")[1] for p in named}
    assert not set(aborted.values()) & left
    with pytest.raises(ValueError, match="stays"):
        store.remove_unused(keep_runs=0)


@pytest.mark.parametrize("fails", [False, True])
def test_a_run_leaves_no_staged_tables(spark, fails):
    src, _, store = seeded(spark)
    before = set(Files(spark).names(shared_folder(spark)))
    if fails:
        src = src | {"ted_mv": src["ted_mv"].withColumn("mv_id", F.raise_error(F.lit("broken")).cast("long"))}
        with pytest.raises(Exception, match="broken"):
            sync_catalog(spark, src, store, VNM, tiny.AS_OF, offset_days=-5000)
    else:
        sync_catalog(spark, src, store, VNM, tiny.AS_OF, offset_days=-5000)
    assert set(Files(spark).names(shared_folder(spark))) == before


def test_first_run_into_an_empty_store(spark):
    src, _, _ = seeded(spark)
    store = Snapshots(spark, folder(spark))
    tables = sync_catalog(spark, src, store, JPN, tiny.AS_OF, offset_days=-5000)
    assert tables["artist"].count() > 0
    assert store.published()[0] == 1


def test_other_regions_and_unchanged_tables_keep_their_folder(spark):
    src, _, store = seeded(spark)
    _, before = store.published()
    nothing_new = {n: df.where(F.lit(False)) for n, df in src.items()}
    sync_catalog(spark, nothing_new, store, VNM, tiny.AS_OF)
    _, after = store.published()
    rewritten = {part for part in after if after[part] != before.get(part)}
    # genre and style are always merged whole; the status from rights is always set anew
    assert {part[:2] for part in rewritten} <= {("genre", ""), ("style", ""), ("album_local", "VNM")}
    assert set(before) <= set(after)


def test_nothing_is_published_when_a_step_fails(spark):
    src, tgt, store = seeded(spark)
    twice = src["tfm_website"].limit(0).unionAll(
        spark.createDataFrame([("ted_artist", i, "x") for i in tiny.IDS] * 2, SOURCES["tfm_website"])
    )
    region = Region("VNM", 19862, 715, 714)
    with pytest.raises(Exception, match="more than one row"):
        sync_catalog(spark, src | {"tfm_website": twice}, store, region, tiny.AS_OF, offset_days=-5000)
    run, folders = store.published()
    assert run == 1
    for name, want in tiny.as_rows(tgt).items():
        assert rows(store.read(folders)[name]) == want
    # and the next attempt is not in the way of the failed one
    sync_catalog(spark, src | {"tfm_website": twice.limit(0)}, store, region, tiny.AS_OF, offset_days=-5000)
    assert store.published()[0] == 2


def test_two_runs_from_one_version_do_not_both_publish(spark):
    _, _, store = seeded(spark)
    run, folders = store.published()
    store.publish(folders, run + 1)
    with pytest.raises(FileExistsError):
        store.publish(folders, run + 1)


def test_rights_run_touches_two_tables_of_one_region(spark):
    src, _, store = seeded(spark)
    _, before = store.published()
    sync_rights(spark, src, store, JPN, tiny.AS_OF, offset_days=-5000)
    _, after = store.published()
    changed = {part[:2] for part in after if after[part] != before.get(part)}
    assert changed <= {("track_local", "JPN"), ("album_local", "JPN")}


def test_only_touched_id_ranges_are_rewritten(spark):
    store = Snapshots(spark, folder(spark), ids_per_part=100)
    src = tiny.frames(spark, {n: [] for n in SOURCES})
    old = {c: None for c in TARGETS["track"].names} | {"track_title": "old"}
    tracks = [old | {"track_id": i, "album_id": 1} for i in range(0, 1000, 10)]
    album = [{c: None for c in TARGETS["album"].names} | {"album_id": 1}]
    empty = {n: [] for n in TARGETS}
    store.seed(tiny.frames(spark, empty | {"track": tracks, "album": album}))
    _, before = store.published()
    assert len([p for p in before if p[0] == "track"]) == 10

    row = {c: None for c in SOURCES["ted_track"].names}
    new = [row | {"track_id": i, "album_id": 1, "track_title": "new"} for i in (15, 20, 1200)]
    region = [{"track_id": i, "nation_cd": "VNM", "crt_dt": tiny.AS_OF} for i in (15, 20, 1200)]
    empty_region = dict.fromkeys(SOURCES["ted_track_w"].names)
    links = [dict.fromkeys(SOURCES["ted_trackartist"].names) | {"track_id": i} for i in (15, 20, 1200)]
    src |= tiny.frames(
        spark, {"ted_track": new, "ted_track_w": [empty_region | r for r in region], "ted_trackartist": links}
    )
    tables = sync_catalog(spark, src, store, VNM, tiny.AS_OF)
    _, after = store.published()
    rewritten = {p for p in after if p[0] == "track" and after[p] != before.get(p)}
    assert rewritten == {("track", "", 0), ("track", "", 12)}
    assert tables["track"].count() == 102
    assert set(rows(tables["track"].where("track_title = 'new'").select("track_id"))) == {(15,), (20,), (1200,)}


# --- runs beside one another, missed days, scattered changes


def file_bytes(spark, folders):
    return sum(Files(spark).size(p) for p in folders)


def test_a_scattered_change_writes_its_own_rows_only(spark):
    store = Snapshots(spark, folder(spark), ids_per_part=10)
    ids = [i * 7919 * 10**10 for i in range(1, 40_001)]
    store.seed({"mv": mvs(spark, ids).repartition(4)})
    _, seeded_version = store.published()
    written_bytes = []
    for n, some in enumerate((ids[:20], ids[10:2000])):
        run, version = store.published()
        fresh = Staging(spark)(mvs(spark, some, f"v{n}"), "fresh")
        before = store.read_for("mv", version, store.parts_of("mv", fresh), fresh)
        assert before.count() == len(some)
        written = store.write(before.drop("mv_title").join(fresh.select("mv_id", "mv_title"), "mv_id").select(*before.columns), "mv", store.new_version(run + 1))
        store.publish_over(run, version, [(written, True)], written)
        written_bytes.append(file_bytes(spark, written.values()) / len(written))
    whole = file_bytes(spark, seeded_version.values()) / len(seeded_version)
    assert written_bytes[0] < 0.8 * whole  # what a parquet file of a row or two takes
    _, version = store.published()
    assert dict(version) == dict(seeded_version)  # no base was written again
    titles = dict.fromkeys(ids, "old") | dict.fromkeys(ids[:20], "v0") | dict.fromkeys(ids[10:2000], "v1")
    assert dict(rows(store.read_table("mv", version).select("mv_id", "mv_title"))) == titles
    folded = store.fold(ratio=0.0)
    assert folded and folded == {k for k in version if version.changes_of(k)}
    _, after = store.published()
    assert not any(after.changes_of(k) for k in after)
    assert dict(rows(store.read_table("mv", after).select("mv_id", "mv_title"))) == titles
    assert store.fold(ratio=0.0) == set()
    store.remove_unused(keep_runs=1)
    assert dict(rows(store.read_table("mv", after).select("mv_id", "mv_title"))) == titles


def test_a_base_rewritten_meanwhile_voids_no_newer_change(spark):
    store = Snapshots(spark, folder(spark), ids_per_part=1)
    ids = [-i for i in range(1, 50)]
    store.seed({"mv": mvs(spark, ids)})
    run, begun = store.published()
    first = store.write(mvs(spark, [-1], "x"), "mv", store.new_version(run + 1))
    store.publish_over(run, begun, [(first, True)], first)
    with pytest.raises(FileExistsError, match="another run"):
        store.publish_over(run, begun, [(first, False)], ())
    other = store.write(mvs(spark, [next(i for i in ids if store.parts_of("mv", mvs(spark, [i])) != store.parts_of("mv", mvs(spark, [-1])))], "y"), "mv", "other")
    merged = store.publish_over(run, begun, [(other, True)], other)
    titles = rows(store.read_table("mv", merged).groupBy("mv_title").count())
    assert titles == [("old", 47), ("x", 1), ("y", 1)]
    assert store.published()[0] == 3
    with pytest.raises(FileExistsError):  # what a run has only read counts too
        store.publish_over(run, begun, [], {("mv",)})


def rights_tables(spark, store):
    tables = store.read(store.published()[1])
    return {n: rows(tables[n]) for n in ("track_local", "album_local")}


def test_rights_of_two_regions_side_by_side(spark, monkeypatch):
    src, tgt, store = seeded(spark)
    one_by_one = Snapshots(spark, folder(spark))
    one_by_one.seed(tiny.frames(spark, tgt))
    for region in (VNM, JPN):
        sync_rights(spark, src, one_by_one, region, tiny.AS_OF, offset_days=-5000)
    publish = Snapshots.publish_over
    rivals = []

    def late(self, *args):
        if not rivals:  # before this run publishes, another one begins and ends
            rivals.append(sync_rights)
            sync_rights(spark, src, Snapshots(spark, store._root), JPN, tiny.AS_OF, offset_days=-5000)
        return publish(self, *args)

    monkeypatch.setattr(Snapshots, "publish_over", late)
    tables = sync_rights(spark, src, store, VNM, tiny.AS_OF, offset_days=-5000)
    assert store.published()[0] == 3
    assert rights_tables(spark, store) == rights_tables(spark, one_by_one)
    assert rows(tables["track_local"]) == rights_tables(spark, store)["track_local"]
    rivals.clear()
    with pytest.raises(FileExistsError, match="another run"):
        sync_rights(spark, src, store, JPN, tiny.AS_OF, offset_days=-5000)


def test_a_missed_day_is_made_up_for(spark):
    src, tgt = tiny.catalogue(12)
    on_day = {1: datetime(2024, 1, 7, 12), 2: datetime(2024, 1, 8, 12), 3: datetime(2024, 1, 9, 12)}
    row = dict.fromkeys(SOURCES["ttmp_trackright"].names) | {"service_id": 716, "right_yn": "Y"}
    rights = [row | {"track_id": i, "crt_dt": at, "upd_dt": at} for i, at in on_day.items()]
    track = {c: None for c in TARGETS["track_local"].names} | {"local_cd": "JPN", "str_rights_yn": "N"}
    tgt |= {"track_local": [track | {"track_id": i} for i in on_day]}
    days = [datetime(2024, 1, 8, 9), datetime(2024, 1, 9, 9), datetime(2024, 1, 10, 9)]
    kept = {}
    for label, runs in {"daily": days, "missed": days[::2], "unmarked": days[::2]}.items():
        store = Snapshots(spark, folder(spark))
        store.seed(tiny.frames(spark, tgt))
        for as_of in runs:
            seen = [r for r in rights if r["crt_dt"] < as_of]
            sync_rights(spark, tiny.frames(spark, src | {"ttmp_trackright": seen}), store, JPN, as_of)
            if label == "unmarked":
                run, version = store.published()
                store.publish(Version(version, version.changes), run + 1)
            else:
                assert store.published()[1].marks == {"JPN": {"ttmp_trackright": as_of.isoformat()}}
        tables = store.read(store.published()[1])
        kept[label] = {n: rows(tables[n].drop("upd_dt")) for n in ("track_local", "album_local")}
    assert kept["daily"] == kept["missed"]
    assert kept["unmarked"]["track_local"] != kept["daily"]["track_local"]


def test_lists_without_changes_and_marks_are_read(spark):
    root = folder(spark)
    store = Snapshots(spark, root)
    store.seed({"mv": mvs(spark, [1])})
    path = Path(root, "published/run-0000000001.json")
    content = json.loads(path.read_text())
    del content["changes"], content["marks"]
    path.write_text(json.dumps(content))
    for crc in path.parent.glob(".*.crc"):
        crc.unlink()
    run, version = Snapshots(spark, root).published()
    assert run == 1 and not version.marks and not version.changes and store.read_table("mv", version).count() == 1


# --- reload and repeat-safe appends


def test_a_failed_reload_leaves_the_old_rows(spark):
    name = new_table(spark, INDEX_DDL)
    first = spark.createDataFrame([(str(i),) for i in range(5)], "contents_1 string")
    truncate_reload(first, name)
    reader = spark.table(name)
    bad = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 999, "x").otherwise(F.raise_error(F.lit("midway")).cast("string")).alias("contents_1"))
    before = set(Files(spark).names(shared_folder(spark)))
    with pytest.raises(Exception, match="midway"):
        truncate_reload(bad, name)
    assert set(Files(spark).names(shared_folder(spark))) == before
    assert rows(spark.table(name)) == rows(first)
    truncate_reload(spark.table(name).where("contents_1 > '2'"), name)
    assert rows(spark.table(name)) == [("3",), ("4",)]
    assert reader.count() == 5  # planned before the reload, it still finds its files
    truncate_reload(first.limit(0), name)
    assert is_empty(spark.table(name))
    append_rows(first, name)
    assert spark.table(name).count() == 5


def test_reloads_leave_two_folders(spark):
    place = folder(spark)
    name = f"t_{uuid.uuid4().hex}"
    ensure_table(spark, name, INDEX_DDL, location=f"{place}/ddl")
    for n in range(4):
        truncate_reload(spark.createDataFrame([(str(n),)], "contents_1 string"), name)
    assert len([n for n in Files(spark).names(place) if "__reload-" in n]) == 2


def test_a_partitioned_table_is_not_reloaded(spark):
    name = new_table(spark, LOGIN_LOG, partition_by=["login_tp"])
    with pytest.raises(ValueError, match="partitions"):
        truncate_reload(spark.createDataFrame([(1,)], "msrl long"), name)


def batch_table(spark):
    name, place = f"t_{uuid.uuid4().hex}", folder(spark)
    ensure_batch_table(spark, name, LOGIN_LOG, place)
    return name, place


def test_append_once(spark):
    name, place = batch_table(spark)
    one = spark.createDataFrame([(1, "x")], "msrl long, login_tp string")
    odd = "it's \\ \"7\" %/="
    assert append_once(one, name, "a") and append_once(one, name, odd)
    assert not append_once(one.limit(0), name, "a") and not append_once(one, name, odd)
    with pytest.raises(Exception, match="midway"):
        append_once(one.withColumn("login_tp", F.raise_error(F.lit("midway")).cast("string")), name, "b")
    assert append_once(one, name, "b")
    assert rows(spark.table(name).select("msrl", "batch")) == sorted([(1, "a"), (1, "b"), (1, odd)], key=repr)
    assert len(Files(spark).names(place)) == 3
    with pytest.raises(ValueError, match="batch"):
        append_once(one.withColumn("batch", F.lit("c")), name, "c")


def test_of_rival_appends_of_one_load_one_wins(spark):
    name, place = batch_table(spark)
    one = spark.createDataFrame([(1,)], "msrl long")
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(lambda _: append_once(one, name, "a"), range(4))).count(True) == 1
    assert spark.table(name).count() == 1 and len(Files(spark).names(place)) == 1
