"""Albums, their region rows, their styles and their status from rights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import changed
from tidemark.functions.status import ACTIVE, BLIND, OK, YES, any_right, status_of
from tidemark.operators.changes import changed_ids, changed_pairs, touched_ids
from tidemark.operators.joins import first_child, has_parent, known_in, with_exists_flag
from tidemark.plans.context import Run, Tables, same_named
from tidemark.plans.styles import changed_styles

KEY = "album_id"


def changed_albums(src: Tables, run: Run) -> DataFrame:
    """Ids the generic sync works on."""
    region, artists = run.of_region(src["ted_album_w"]), src["ted_albumartist"]
    recent = run.of_region(run.recent(src, "ted_album_w")), run.recent(src, "ted_albumartist")
    return run.stage(changed_ids(region, artists, None, KEY, run.cut, run.stage, recent), "album_ids")


def sync_album(src: Tables, tgt: Tables, run: Run, ids: DataFrame | None = None) -> DataFrame:
    base, region = src["ted_album"], run.of_region(src["ted_album_w"])
    artists = src["ted_albumartist"]
    if run.region.regional:
        own = [run.recent(src, "ted_album"), run.of_region(run.recent(src, "ted_album_w"))]
        ids = run.stage(touched_ids(KEY, run.cut, own, run.recent(src, "ted_albumartist")), "album_ids")
        rows = changed_pairs(base, region, ids, KEY, run.cut)
        status = status_of("db_sts", "w_db_sts", approved="svc_aprv_yn")
    else:
        ids = changed_albums(src, run) if ids is None else ids
        rows = has_parent(base, ids, [KEY])
        status = status_of("db_sts")
    rows = first_child(
        rows,
        has_parent(artists, ids, [KEY]),
        KEY,
        "artist_id",
        (F.col("rp_cd") == YES) & (F.col("db_sts") == ACTIVE),
        tgt["artist"],
        run.stage,
    )
    copied = ["title", "search_title", "artist_id", "nation_cd", "release_ymd"]
    written = same_named(*copied, "status") | {
        "keyword": "src.search_title",
        "album_tp": "src.album_type",
        "agency_id": F.lit(run.region.agency_id),
    }
    return run.upsert(
        tgt["album"],
        rows.select(KEY, *copied, "album_type", "crt_dt", status.alias("status")),
        "album",
        [KEY],
        on_match=written | {"upd_dt": run.now},
        on_insert=written | same_named("crt_dt"),
    )


def sync_album_local(src: Tables, tgt: Tables, run: Run, ids: DataFrame | None = None) -> DataFrame:
    region = run.of_region(src["ted_album_w"])
    if run.region.regional:
        own = [run.of_region(run.recent(src, "ted_album_w"))]
        touched = touched_ids(KEY, run.cut, own, run.recent(src, "ted_albumartist"), ("upd_dt",))
        touched = known_in(run.stage(touched, "album_local_ids"), tgt["album"], [KEY], run.stage)
        rows = region.join(run.stage(touched, "album_local_known"), KEY).where(
            changed(run.cut, "crt_dt", "upd_dt") | F.col("by_child")
        )
    else:
        rows = has_parent(region, changed_albums(src, run) if ids is None else ids, [KEY])
    titles = {"title_local": "src.title", "search_title_local": "src.title"}
    return run.upsert(
        tgt["album_local"],
        rows.select(
            KEY, run.code.alias("local_cd"), "title", "crt_dt", status_of("db_sts").alias("status")
        ),
        "album_local",
        [KEY, "local_cd"],
        on_match=titles | same_named("status") | {"upd_dt": run.now},
        on_insert=titles | same_named("crt_dt", "status"),
    )


def changed_album_styles(src: Tables, run: Run) -> DataFrame:
    """Style rows that drive both album_style and track_style."""
    return changed_styles(src, "tbm_albumstyle", KEY, run.of_region(src["ted_album_w"]), run)


def sync_album_style(src: Tables, tgt: Tables, run: Run, styles: DataFrame | None = None) -> DataFrame:
    rows = changed_album_styles(src, run) if styles is None else styles
    if run.region.regional:
        rows = known_in(rows, tgt["album"], [KEY], run.stage)
        rows = known_in(rows, tgt["style"], ["style_id"], run.stage)
    return run.upsert(
        tgt["album_style"],
        rows.select(KEY, "style_id", "listorder", "crt_dt"),
        "album_style",
        [KEY, "style_id"],
        on_match=same_named("listorder"),
        on_insert=same_named("listorder", "crt_dt"),
    )


def sync_track_style(src: Tables, tgt: Tables, run: Run, styles: DataFrame | None = None) -> DataFrame:
    """Every track inherits its album's styles. A huge album is split by AQE's skew join."""
    rows = changed_album_styles(src, run) if styles is None else styles
    rows = rows.select(KEY, "style_id", "listorder", "crt_dt")
    if run.region.regional:
        rows = known_in(rows, tgt["style"], ["style_id"], run.stage)
    rows = rows.join(tgt["track"].select("track_id", KEY), KEY).drop(KEY)
    return run.upsert(
        tgt["track_style"],
        rows,
        "track_style",
        ["track_id", "style_id"],
        on_match=same_named("listorder"),
        on_insert=same_named("listorder", "crt_dt"),
    )


def album_status_by_rights(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    """Region albums without a usable right go BLIND; others with a status go OK."""
    held = src["ttmp_trackright"].where(any_right(run.region.services))
    target = tgt["album_local"]
    here = F.col("local_cd") == run.code
    has = F.col("__has_right")
    reopened = here & has & (F.col("status") != OK)
    flagged = with_exists_flag(target, held, [KEY], "__has_right", run.stage)
    return flagged.select(
        *[
            F.when(here & ~has, BLIND).when(reopened, OK).otherwise(F.col(c)).alias(c)
            if c == "status"
            else F.when((here & ~has) | reopened, run.now).otherwise(F.col(c)).alias(c)
            if c == "upd_dt"
            else F.col(c)
            for c in target.columns
        ]
    )
