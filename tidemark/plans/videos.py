"""Music videos and their region rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.status import ACTIVE, BLIND, DELETED, status_of
from tidemark.operators.apply import update_if
from tidemark.operators.changes import changed_ids, changed_pairs, changed_since, touched_ids
from tidemark.operators.joins import distinct_keys, has_parent, known_in, top1
from tidemark.plans.context import Run, Tables, same_named
from tidemark.schemas import TARGETS

KEY = "mv_id"


def changed_mvs(src: Tables, run: Run) -> DataFrame:
    """Ids that drive mv, and mv_local in the generic sync."""
    recent = run.of_region(run.recent(src, "ted_mv_w")), run.recent(src, "ted_mvtrack")
    if run.region.regional:
        ids = touched_ids(KEY, run.cut, [run.recent(src, "ted_mv"), recent[0]], recent[1], ("upd_dt",))
    else:
        region = run.of_region(src["ted_mv_w"])
        ids = changed_ids(region, src["ted_mvtrack"], None, KEY, run.cut, run.stage, recent)
    return run.stage(ids, "mv_ids")


def blind_deleted_mv(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    """Videos whose link to their track was deleted since the cut go BLIND."""
    gone = changed_since(
        run.recent(src, "ted_mvtrack").where(F.col("db_sts") == DELETED), run.cut, ("upd_dt",)
    )
    gone = run.stage(distinct_keys(gone, [KEY, "track_id"]), "deleted_mvtrack")
    if run.stage.is_empty(gone):
        return tgt["mv"]
    return update_if(
        tgt["mv"], gone, [KEY, "track_id"], {"status": F.lit(BLIND), "upd_dt": run.now}, stage=run.stage
    )


def first_track_of_mv(links: DataFrame) -> DataFrame:
    """The link with the smallest id per video; the track id decides ties."""
    order = [F.col("mvtrack_id").asc_nulls_last(), F.col("track_id").asc_nulls_last()]
    return top1(links.select(KEY, "mvtrack_id", "track_id"), [KEY], order).drop("mvtrack_id")


def sync_mv(src: Tables, tgt: Tables, run: Run, ids: DataFrame | None = None) -> DataFrame:
    base, region, links = src["ted_mv"], run.of_region(src["ted_mv_w"]), src["ted_mvtrack"]
    ids = changed_mvs(src, run) if ids is None else ids
    if run.region.regional:
        rows = changed_pairs(base, region, ids, KEY, run.cut)
        status = status_of("db_sts", "w_db_sts", approved="svc_aprv_yn")
        updated = "w_upd_dt"
        links = links.where(F.col("db_sts") == ACTIVE)
    else:
        rows = has_parent(base, ids, [KEY])
        status = status_of("db_sts")
        updated = "upd_dt"
    # staged before they are ranked by the same key, so that Spark may split a video
    # with very many links in this join and cut its ranks per task afterwards
    links = run.stage(has_parent(links, ids, [KEY]), "mv_links")
    rows = rows.join(first_track_of_mv(links), KEY)
    # staged, the few rows are broadcast to the tracks and not the other way round
    rows = run.stage(rows, "mv_rows").join(tgt["track"].select("track_id", "artist_id"), "track_id")
    renamed = {"upd_dt": F.col(updated), "status": status, "highrate_yn": F.col("high_yn")}
    names = TARGETS["mv"].names
    written = [c for c in names if c not in (KEY, "upd_dt")]
    return run.upsert(
        tgt["mv"],
        rows.select(*[renamed.get(c, F.col(c)).alias(c) for c in names]),
        "mv",
        [KEY],
        on_match=same_named(*written) | {"upd_dt": run.now},
        on_insert=same_named(*written, "upd_dt"),
    )


def sync_mv_local(src: Tables, tgt: Tables, run: Run, ids: DataFrame | None = None) -> DataFrame:
    region = run.of_region(src["ted_mv_w"])
    if run.region.regional:
        recent = run.of_region(run.recent(src, "ted_mv_w"))
        rows = run.stage(changed_since(recent, run.cut), "mv_local_rows")
        inserted = {}
    else:
        rows = has_parent(region, changed_mvs(src, run) if ids is None else ids, [KEY])
        rows = run.stage(rows, "mv_local_rows")
        # the generic sync merges the same rows twice, so new rows end up as updated
        inserted = {"upd_dt": run.now}
    rows = known_in(rows, tgt["mv"], [KEY], run.stage)
    titles = {"mv_title_local": "src.mv_title"}
    return run.upsert(
        tgt["mv_local"],
        rows.select(
            KEY, run.code.alias("local_cd"), "mv_title", "crt_dt", status_of("db_sts").alias("status")
        ),
        "mv_local",
        [KEY, "local_cd"],
        on_match=titles | same_named("status") | {"upd_dt": run.now},
        on_insert=titles | same_named("crt_dt", "status") | inserted,
    )
