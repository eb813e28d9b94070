"""Declared schemas of every source and target table.

A column is text unless marked: ``:n`` is a 64-bit number, ``:t`` a timestamp
without time zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {"": StringType(), "n": LongType(), "t": TimestampNTZType()}


def table(columns: str) -> StructType:
    fields = (c.partition(":") for c in columns.split())
    return StructType([StructField(name, _TYPES[kind]) for name, _, kind in fields])


SOURCES: dict[str, StructType] = {
    "ted_artist": table(
        "artist_id:n artist_nm disp_nm search_nm birth_ymd nation_cd grp_cd sex_cd "
        "act_start_ymd act_end_ymd crt_dt:t upd_dt:t db_sts"
    ),
    "ted_artist_w": table("artist_id:n nation_cd artist_nm crt_dt:t upd_dt:t db_sts"),
    "tfm_website": table("rel_entity_cd rel_id:n site_url"),
    "tbm_artiststyle": table("artist_id:n style_id:n listorder:n crt_dt:t"),
    "ted_album": table(
        "album_id:n title search_title nation_cd release_ymd album_type svc_aprv_yn "
        "crt_dt:t upd_dt:t db_sts"
    ),
    "ted_album_w": table("album_id:n nation_cd title crt_dt:t upd_dt:t db_sts"),
    "ted_albumartist": table("album_id:n artist_id:n rp_cd crt_dt:t upd_dt:t db_sts"),
    "tbm_albumstyle": table("album_id:n style_id:n listorder:n crt_dt:t"),
    "ted_track": table(
        "track_id:n media_no:n disc_id:n track_no:n track_title title_yn len:n album_id:n "
        "svc_128_yn svc_192_yn svc_320_yn svc_mmp3_yn svc_flac_yn svc_wave_yn "
        "crt_dt:t upd_dt:t db_sts"
    ),
    "ted_track_w": table(
        "track_id:n nation_cd track_title track_title_alt search_title crt_dt:t upd_dt:t db_sts"
    ),
    "ted_trackartist": table("track_id:n artist_id:n rp_cd upd_dt:t db_sts"),
    "ttmp_trackright": table("track_id:n album_id:n service_id:n right_yn crt_dt:t upd_dt:t"),
    "ted_mv": table(
        "mv_id:n media_no:n mv_title nation_cd attr_tp high_yn actor dscr release_ymd media_yn "
        "svc_aprv_yn svc_fullhd_yn svc_hd_yn svc_sd_yn svc_mp4_yn crt_dt:t upd_dt:t db_sts"
    ),
    "ted_mv_w": table("mv_id:n nation_cd mv_title crt_dt:t upd_dt:t db_sts"),
    "ted_mvtrack": table("mvtrack_id:n mv_id:n track_id:n upd_dt:t db_sts"),
    "tmu_genre": table("genre_cd:n pgenre_cd:n genre_nm"),
    "time_lyrics": table("track_id:n local_cd"),
    "normal_lyrics": table("track_id:n local_cd"),
}

# Sources kept in a second origin; they may be loaded from another root.
LYRICS_SOURCES = ("time_lyrics", "normal_lyrics")

TARGETS: dict[str, StructType] = {
    "artist": table(
        "artist_id:n artist_nm disp_nm search_nm birth_ymd nation_cd grp_cd sex_cd homepage_url "
        "act_start_ymd act_end_ymd crt_dt:t upd_dt:t status"
    ),
    "artist_local": table(
        "artist_id:n local_cd disp_nm_local search_nm_local crt_dt:t upd_dt:t status"
    ),
    "artist_style": table("artist_id:n style_id:n listorder:n crt_dt:t"),
    "album": table(
        "album_id:n title search_title artist_id:n nation_cd release_ymd keyword album_tp "
        "crt_dt:t upd_dt:t status agency_id:n"
    ),
    "album_local": table(
        "album_id:n local_cd title_local search_title_local crt_dt:t upd_dt:t status"
    ),
    "album_style": table("album_id:n style_id:n listorder:n crt_dt:t"),
    "track": table(
        "track_id:n media_no:n disc_id:n track_no:n track_title title_yn len:n crt_dt:t upd_dt:t "
        "album_id:n artist_id:n svc_128_yn svc_192_yn svc_320_yn svc_wma_yn svc_flac_yn "
        "svc_wave_yn status"
    ),
    "track_local": table(
        "track_id:n local_cd track_title_local crt_dt:t upd_dt:t status str_rights_yn "
        "dnl_rights_yn mv_str_rights_yn lyrics_tp rent_rights_yn track_title_alt search_title"
    ),
    "track_style": table("track_id:n style_id:n listorder:n crt_dt:t"),
    "mv": table(
        "mv_id:n track_id:n artist_id:n media_no:n mv_title nation_cd attr_tp highrate_yn actor "
        "dscr release_ymd media_yn crt_dt:t upd_dt:t status svc_fullhd_yn svc_hd_yn svc_sd_yn "
        "svc_mp4_yn"
    ),
    "mv_local": table("mv_id:n local_cd mv_title_local crt_dt:t upd_dt:t status"),
    "genre": table("genre_id:n genre_nm crt_dt:t"),
    "style": table("style_id:n genre_id:n style_nm crt_dt:t"),
}

# Targets that grow with the catalogue, and the id whose ranges split them.
PART_KEYS = {n: schema.names[0] for n, schema in TARGETS.items() if n not in ("genre", "style")}

# Targets with one row per region; they are split by region code as well.
REGION_TARGETS = ("artist_local", "album_local", "track_local", "mv_local")

LOGIN_EVENT = table("msrl:n sso_srl:n login_ip login_tp widget_ref sso")

LOGIN_LOG = table(
    "msrl:n sso_srl:n login_ip1 login_tp login_dt widget_ref m_app_ver m_platform_nm "
    "m_platform_ver m_device_nm m_comp_nm m_device_no m_exception"
)

DDL_TEXT = table("owner index_name ddl")
INDEX_DDL = table("contents_1")
