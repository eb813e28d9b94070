"""Tracks, their region rows with rights, and their lyrics type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.status import ACTIVE, YES, status_of, yes_no
from tidemark.operators.apply import update_from_lookup
from tidemark.operators.changes import base_with_region, changed_ids
from tidemark.operators.joins import first_child, has_parent, known_in, raise_if
from tidemark.plans.context import Run, Tables, same_named
from tidemark.plans.rights import rights_per_track, several_rights

KEY = "track_id"
QUALITY_FLAGS = ("svc_128_yn", "svc_192_yn", "svc_320_yn", "svc_flac_yn", "svc_wave_yn")
TIMED = "T"
NORMAL = "N"


def changed_tracks(src: Tables, run: Run) -> DataFrame:
    """Ids that drive track, track_local and lyrics."""
    region = run.of_region(src["ted_track_w"])
    base = run.recent(src, "ted_track") if run.region.regional else None
    recent = run.of_region(run.recent(src, "ted_track_w")), run.recent(src, "ted_trackartist")
    return run.stage(
        changed_ids(region, src["ted_trackartist"], base, KEY, run.cut, run.stage, recent), "track_ids"
    )


def sync_track(src: Tables, tgt: Tables, run: Run, ids: DataFrame | None = None) -> DataFrame:
    ids = changed_tracks(src, run) if ids is None else ids
    base = src["ted_track"]
    if run.region.regional:
        rows = base_with_region(base, run.of_region(src["ted_track_w"]), ids, KEY)
        rows = known_in(run.stage(rows, "track_rows"), tgt["album"], ["album_id"], run.stage)
        status = status_of("db_sts", "w_db_sts")
    else:
        rows = has_parent(base, ids, [KEY])
        status = status_of("db_sts")
    rows = first_child(
        rows,
        has_parent(src["ted_trackartist"], ids, [KEY]),
        KEY,
        "artist_id",
        (F.col("rp_cd") == YES) & (F.col("db_sts") == ACTIVE),
        tgt["artist"],
        run.stage,
    )
    copied = ["media_no", "disc_id", "track_no", "track_title", "len", "crt_dt", "album_id", "artist_id"]
    flags = {c: yes_no(c) for c in ("title_yn", *QUALITY_FLAGS)} | {"svc_wma_yn": yes_no("svc_mmp3_yn")}
    delta = rows.select(
        KEY, *copied, *[c.alias(n) for n, c in flags.items()], status.alias("status")
    )
    written = same_named(*copied, *flags, "status")
    return run.upsert(
        tgt["track"],
        delta,
        "track",
        [KEY],
        on_match=written | {"upd_dt": run.now},
        on_insert=written,
    )


def sync_track_local(src: Tables, tgt: Tables, run: Run, ids: DataFrame | None = None) -> DataFrame:
    ids = changed_tracks(src, run) if ids is None else ids
    region = run.region
    if region.regional:
        ids = run.stage(known_in(ids, tgt["track"], [KEY], run.stage), "known_track_ids")
    rows = has_parent(run.of_region(src["ted_track_w"]), ids, [KEY])

    services = {"str": region.streaming, "dnl": region.download}
    if region.rental is not None:
        services["rent"] = region.rental
    rights = rights_per_track(has_parent(src["ttmp_trackright"], ids, [KEY]), services)
    rows = rows.join(rights, KEY, "left").where(
        raise_if(several_rights(services), "more than one right of a track for a service")
    )

    alt = ["track_title_alt", "search_title"] if region.alt_titles else []
    delta = rows.select(
        KEY,
        run.code.alias("local_cd"),
        "track_title",
        "crt_dt",
        status_of("db_sts").alias("status"),
        *[yes_no(f"{name}_yn").alias(f"{name}_rights_yn") for name in services],
        *alt,
    )
    rights_set = same_named(*[f"{name}_rights_yn" for name in services])
    streaming_video = {"mv_str_rights_yn": "src.str_rights_yn"}
    common = {"track_title_local": "src.track_title"} | rights_set | same_named(*alt)
    return run.upsert(
        tgt["track_local"],
        delta,
        "track_local",
        [KEY, "local_cd"],
        on_match=common
        | (streaming_video if region.match_sets_mv_rights else {})
        | (same_named("status") if region.match_sets_status else {})
        | {"upd_dt": run.now},
        on_insert=common | streaming_video | same_named("crt_dt", "status"),
    )


def lyric_types(src: Tables, run: Run, ids: DataFrame) -> DataFrame:
    """One row per track and region with lyrics, ``timed`` if any of them are timed."""
    found = (
        src["time_lyrics"]
        .select(KEY, "local_cd", F.lit(True).alias("timed"))
        .unionAll(src["normal_lyrics"].select(KEY, "local_cd", F.lit(False).alias("timed")))
    )
    # staged before it is grouped by the same key, so that Spark may split a hot track here
    found = run.stage(has_parent(found, ids, [KEY]), "lyrics")
    per_row = found.groupBy(KEY, "local_cd").agg(F.max("timed").alias("timed"))
    return run.stage(per_row, "lyric_types")


def set_lyrics_type(track_local: DataFrame, types: DataFrame) -> DataFrame:
    """Timed lyrics win and stick; normal ones only fill in."""
    timed = F.col("src.timed") | (F.col("lyrics_tp") == TIMED)
    return update_from_lookup(
        track_local,
        types,
        [KEY, "local_cd"],
        {"lyrics_tp": F.when(timed, TIMED).otherwise(NORMAL)},
        bad=F.lit(False),
    )


def sync_lyrics_type(src: Tables, tgt: Tables, run: Run, ids: DataFrame | None = None) -> DataFrame:
    ids = changed_tracks(src, run) if ids is None else ids
    return set_lyrics_type(tgt["track_local"], lyric_types(src, run, ids))
