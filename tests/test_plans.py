"""Plans that decide how the work scales."""

from __future__ import annotations

import re
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import REGIONS, STEPS
from checks.standin import AS_OF, sources, targets
from tidemark import VNM
from tidemark.operators.apply import update_from_lookup, update_if, upsert
from tidemark.operators.changes import changed_since
from tidemark.operators.joins import distinct_keys, first_child, has_parent, lacks, lookup_one, top1, with_exists_flag
from tidemark.plans import tracks
from tidemark.plans.context import Run
from tidemark.sources.catalog import load_sources
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.staging import Staging, shared_folder

CUT = datetime(2000, 6, 14)
SOME_ROWS = "/root/testdata/sf0.01"  # enough for every step to find a change


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above(plan: str, text: str) -> list[str]:
    """Operators between the plan's root and each scan whose line holds the text."""
    found, path = [], []
    for line in plan.splitlines():
        name = re.search(r"[A-Za-z]", line)
        if not name:
            continue
        depth = name.start()
        path = [(d, l) for d, l in path if d < depth] + [(depth, line[depth:])]
        if "FileScan" in line and text in line:
            found += [l for _, l in path[:-1]]
    return found


@pytest.fixture(scope="module")
def stored(spark):
    """Sources and targets as parquet tables, the way a job reads them."""
    root = f"{shared_folder(spark)}/plans-{uuid.uuid4().hex}"
    for name, df in sources(spark, SOME_ROWS).items():
        df.write.parquet(f"{root}/src/{name}")
    store = Snapshots(spark, f"{root}/tgt")
    store.seed(targets(spark, SOME_ROWS))
    return load_sources(spark, f"{root}/src"), store.read(store.published()[1])


def test_change_filter_and_columns_reach_the_scan(spark, stored):
    src, _ = stored
    plan = plan_of(changed_since(src["ted_track_w"].where("nation_cd = 'VNM'"), CUT).select("track_id"))
    assert "PushedFilters: [IsNotNull(nation_cd), EqualTo(nation_cd,VNM), Or(GreaterThan(crt_dt" in plan
    assert "ReadSchema: struct<track_id:bigint,nation_cd:string,crt_dt:timestamp_ntz,upd_dt:timestamp_ntz>" in plan


UPDATED = {"lyrics_type": "track_local", "album_status": "album_local", "blind_deleted_mv": "mv"} | {
    f"{kind}_rights": "track_local" for kind in ("stream", "download", "rental", "track")
}


@pytest.mark.parametrize(("name", "step", "labels"), [(n, s, k) for n, s, _, k in STEPS])
def test_a_small_change_does_not_shuffle_its_target(spark, stored, name, step, labels):
    src, tgt = stored
    for label in labels:
        plan = plan_of(step(src, tgt, Run.start(spark, REGIONS[label], AS_OF)))
        operators = above(plan, f"/{UPDATED.get(name, name)}/part_")
        assert operators, plan
        assert not [o for o in operators if o.startswith("Exchange")], plan


def test_a_run_reads_only_its_region_of_a_target(spark, stored):
    src, tgt = stored
    plan = plan_of(tracks.sync_track_local(src, tgt, Run.start(spark, VNM, AS_OF)).where("local_cd = 'VNM'"))
    assert "part_cd=VNM" in plan and "part_cd=JPN" not in plan


def test_rank_one_is_cut_before_the_shuffle(spark, stored):
    src, _ = stored
    plan = plan_of(top1(src["ted_mvtrack"].select("mv_id", "mvtrack_id"), ["mv_id"], ["mvtrack_id"]))
    partial = plan.index("WindowGroupLimit [mv_id", plan.index("Exchange"))
    assert "Partial" in plan[partial:]


def test_keys_are_reduced_before_the_shuffle(spark, stored, no_broadcast):
    src, _ = stored
    plan = plan_of(distinct_keys(src["ted_trackartist"], ["track_id"]))
    operators = above(plan, "ted_trackartist")
    shuffled = max(i for i, o in enumerate(operators) if o.startswith("Exchange"))
    assert any(o.startswith("HashAggregate") for o in operators[shuffled:])


def test_one_key_with_a_third_of_the_rows(spark, no_broadcast):
    """A hot key is folded on the map side, and the result is whole."""
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    base = spark.range(30_000).select(F.col("id").alias("k"))
    first = top1(Staging(spark)(hot, "hot"), ["k"], ["v"])
    assert first.where("k = 7").first()["v"] == 0
    assert has_parent(base, hot, ["k"], unique=False).count() == hot.select("k").distinct().count()
    assert has_parent(hot, base.where("k = 7"), ["k"]).count() == 10_001


N = 60_000


def _hot(spark, key):
    """Rows a third of which have one key, staged as a table of its own."""
    rows = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, key).otherwise(F.col("id")).cast("long").alias("k"),
        F.concat(F.lit("v"), F.sha2(F.col("id").cast("string"), 512)).alias("v"),
    )
    return Staging(spark)(rows, "hot")


def _operators(spark):
    side = Staging(spark)(spark.range(0, N, 2).select(F.col("id").alias("k"), F.concat(F.lit("w"), "id").alias("w")), "side")
    links = side.select("k", F.col("k").alias("c"), F.lit("Y").alias("ok"))
    value = {"v": F.lit("new")}
    return {
        "upsert": lambda t: upsert(t, side, ["k"], {"v": "src.w"}, {"v": "src.w"}),
        "update_if": lambda t: update_if(t, side, ["k"], value),
        "update_if_not": lambda t: update_if(t, side, ["k"], value, exists=False),
        "update_from_lookup": lambda t: update_from_lookup(t, side, ["k"], {"v": "src.w"}),
        "with_exists_flag": lambda t: with_exists_flag(t, side, ["k"], "f"),
        "lacks": lambda t: lacks(t, side, ["k"]),
        "has_parent": lambda t: has_parent(t, side, ["k"], unique=False),
        "lookup_one": lambda t: lookup_one(t, side, ["k"], "w", "found", "none"),
        "first_child": lambda t: first_child(t, links, "k", "c", F.col("ok") == "Y", links.select("c")),
    }


NAMES = ["upsert", "update_if", "update_if_not", "update_from_lookup", "with_exists_flag", "lacks", "has_parent", "lookup_one", "first_child"]
SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("key", [6, None])
@pytest.mark.parametrize("name", NAMES)
def test_hot_and_missing_keys(spark, no_broadcast, skew_settings, name, key):
    """A hot key is split in the join; rows without a key are not in it."""
    target = _hot(spark, key)
    apply = _operators(spark)[name]
    # each operator is right on a few rows of its own (test_operators); here no row may go missing
    got = apply(target)
    counted = {r[0]: r[1] for r in got.groupBy(F.col("k").isNull()).count().collect()}
    third, even, odd = N // 3, sum(1 for i in range(N) if i % 3 and i % 2 == 0), sum(1 for i in range(N) if i % 3 and i % 2)
    wanted = {
        "lacks": odd + (0 if key else third),
        "has_parent": even + (third if key else 0),
        "upsert": N + N // 2 - even - (1 if key else 0),
    }.get(name, N)
    assert sum(counted.values()) == wanted
    assert counted.get(True, 0) == (0 if key or name == "has_parent" else third)
    frame = apply(target)
    frame.collect()
    text = plan_of(frame)
    joins = re.findall(r"SortMergeJoin(?:\(skew=true\))? \[k#\d+L?\].*(?:LeftOuter|LeftAnti|LeftSemi)", text)
    assert joins, text
    if key:
        assert any("skew=true" in j for j in joins), text
    # every scan of the target that a join reads asks for keys
    for line in text.splitlines():
        if "FileScan" in line and "_hot" in line:
            assert "IsNotNull(k)" in line or "IsNull(k)" in line or "ReadSchema: struct<k:bigint>" in line, line


def test_upsert_sorts_no_change_to_count_it(spark, no_broadcast):
    target, change = _hot(spark, None), _hot(spark, 6).where("k <> 6")
    frame = upsert(target, change, ["k"], {"v": "src.v"}, {"v": "src.v"})
    frame.collect()
    assert "SortAggregate" not in plan_of(frame)
