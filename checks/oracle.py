"""What each step of the sync must yield, as SQL over the stand-in tables.

An upsert is written as one FULL JOIN here, unlike in the library.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from checks.standin import AS_OF
from tidemark.schemas import TARGETS

CUT = "TIMESTAMP '2000-06-14 00:00:00'"
NOW = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"


@dataclass(frozen=True)
class Rules:
    """The expected settings, stated again so that a wrong region record shows."""

    code: str
    agency: str
    services: Mapping[str, int]
    regional: bool = True


RULES = {
    "vnm": Rules("VNM", "19862", {"str": 715, "dnl": 714}),
    "jpn": Rules("JPN", "20382", {"str": 716, "dnl": 717, "rent": 718}),
    "generic": Rules("VNM", "19862", {"str": 715, "dnl": 714}, regional=False),
    "generic_jpn": Rules("JPN", "NULL", {"str": 715, "dnl": 714}, regional=False),
}


def fresh(*aliases: str) -> str:
    return "(" + " OR ".join(f"{a}.crt_dt > {CUT} OR {a}.upd_dt > {CUT}" for a in aliases) + ")"


def ok(*conditions: str) -> str:
    return f"CASE WHEN {' AND '.join(conditions)} THEN 'OK' ELSE 'BLIND' END"


def merge(
    target: str,
    delta: str,
    keys: list[str],
    on_match: Mapping[str, str],
    on_insert: Mapping[str, str],
    columns: list[str] | None = None,
    name: str | None = None,
) -> str:
    """The target after the upsert; ``s`` is the delta row."""
    columns = columns or TARGETS[target].names
    inserted = {k: f"s.{k}" for k in keys} | dict(on_insert)
    chosen = ", ".join(
        f"CASE WHEN t.here IS NULL THEN {inserted.get(c, 'NULL')} "
        f"WHEN s.here IS NULL THEN t.{c} ELSE {on_match.get(c, f't.{c}')} END AS {c}"
        for c in columns
    )
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (
        f"SELECT {chosen} FROM (SELECT *, 1 AS here FROM {name or target}) t "
        f"FULL JOIN (SELECT *, 1 AS here FROM ({delta}) d) s ON {on}"
    )


def same(*columns: str) -> dict[str, str]:
    return {c: f"s.{c}" for c in columns}


Names = Mapping[str, str]


def _n(names: Names, table: str) -> str:
    return names.get(table, table)


def genre(r: Rules, names: Names) -> str:
    delta = "SELECT genre_cd AS genre_id, genre_nm FROM tmu_genre WHERE genre_cd = pgenre_cd"
    nm = {"genre_nm": "s.genre_nm"}
    return merge("genre", delta, ["genre_id"], nm, nm | {"crt_dt": NOW}, name=_n(names, "genre"))


def style(r: Rules, names: Names) -> str:
    delta = f"""SELECT pgenre_cd AS style_id, genre_cd AS genre_id, genre_nm AS style_nm FROM tmu_genre
                WHERE genre_cd <> pgenre_cd AND genre_cd IN (SELECT genre_id FROM {_n(names, 'genre')})"""
    return merge(
        "style", delta, ["style_id"], same("style_nm"), same("style_nm", "genre_id") | {"crt_dt": NOW},
        name=_n(names, "style"),
    )


def artist(r: Rules, names: Names) -> str:
    site = "(SELECT x.site_url FROM tfm_website x WHERE x.rel_entity_cd = 'ted_artist' AND x.rel_id = b.artist_id)"
    if r.regional:
        picked = f"""FROM ted_artist b JOIN ted_artist_w w ON w.artist_id = b.artist_id AND w.nation_cd = '{r.code}'
                     WHERE {fresh('b', 'w')}"""
        status = ok("b.db_sts = 'A'", "w.db_sts = 'A'")
    else:
        picked = f"""FROM ted_artist b WHERE b.artist_id IN
                     (SELECT w.artist_id FROM ted_artist_w w WHERE w.nation_cd = '{r.code}' AND {fresh('w')})"""
        status = ok("b.db_sts = 'A'")
    delta = f"SELECT b.* EXCLUDE (upd_dt, db_sts), {site} AS homepage_url, {status} AS status {picked}"
    cols = [c for c in TARGETS["artist"].names if c not in ("artist_id", "upd_dt")]
    return merge(
        "artist", delta, ["artist_id"], same(*cols) | {"upd_dt": NOW}, same(*cols), name=_n(names, "artist")
    )


def artist_local(r: Rules, names: Names) -> str:
    parent = f"AND w.artist_id IN (SELECT artist_id FROM {_n(names, 'artist')})" if r.regional else ""
    delta = f"""SELECT w.artist_id, w.nation_cd AS local_cd, w.artist_nm, w.crt_dt, {ok("w.db_sts = 'A'")} AS status
                FROM ted_artist_w w WHERE w.nation_cd = '{r.code}' AND {fresh('w')} {parent}"""
    both = {"disp_nm_local": "s.artist_nm", "search_nm_local": "s.artist_nm", "status": "s.status"}
    return merge(
        "artist_local", delta, ["artist_id", "local_cd"], both | {"upd_dt": NOW}, both | same("crt_dt"),
        name=_n(names, "artist_local"),
    )


def _styles(r: Rules, names: Names, table: str, region: str, key: str, parent: str | None) -> str:
    if r.regional:
        has = f"AND x.{key} IN (SELECT {key} FROM {_n(names, parent)})" if parent else ""
        return f"""SELECT x.* FROM {table} x WHERE x.crt_dt > {CUT} {has}
                   AND x.style_id IN (SELECT style_id FROM {_n(names, 'style')})"""
    return f"""SELECT x.* FROM {table} x WHERE x.{key} IN (SELECT y.{key} FROM {table} y WHERE y.crt_dt > {CUT})
               AND x.{key} IN (SELECT w.{key} FROM {region} w WHERE w.nation_cd = '{r.code}')"""


def artist_style(r: Rules, names: Names) -> str:
    delta = _styles(r, names, "tbm_artiststyle", "ted_artist_w", "artist_id", "artist")
    return merge(
        "artist_style", delta, ["artist_id", "style_id"], same("listorder"), same("listorder") | {"crt_dt": NOW},
        name=_n(names, "artist_style"),
    )


def _first_artist(names: Names, assoc: str, key: str) -> str:
    return f"""(SELECT min(x.artist_id) FROM {assoc} x WHERE x.{key} = b.{key} AND x.rp_cd = 'Y' AND x.db_sts = 'A'
                AND x.artist_id IN (SELECT artist_id FROM {_n(names, 'artist')})) AS artist_id"""


def generic_ids(key: str, region: str, assoc: str, code: str) -> str:
    """Ids with a region row and an association row, one of them changed."""
    return f"""SELECT w.{key} FROM {region} w JOIN {assoc} x ON x.{key} = w.{key}
               WHERE w.nation_cd = '{code}' AND ({fresh('w')} OR x.upd_dt > {CUT})"""


def album(r: Rules, names: Names) -> str:
    if r.regional:
        picked = f"""FROM ted_album b JOIN ted_album_w w ON w.album_id = b.album_id AND w.nation_cd = '{r.code}'
                     WHERE {fresh('b', 'w')}
                        OR b.album_id IN (SELECT y.album_id FROM ted_albumartist y WHERE {fresh('y')})"""
        status = ok("b.db_sts = 'A'", "w.db_sts = 'A'", "b.svc_aprv_yn = 'Y'")
    else:
        ids = generic_ids("album_id", "ted_album_w", "ted_albumartist", r.code)
        picked, status = f"FROM ted_album b WHERE b.album_id IN ({ids})", ok("b.db_sts = 'A'")
    delta = f"""SELECT b.* EXCLUDE (db_sts), {_first_artist(names, 'ted_albumartist', 'album_id')},
                {status} AS status {picked}"""
    both = same("title", "search_title", "artist_id", "nation_cd", "release_ymd", "status") | {
        "keyword": "s.search_title",
        "album_tp": "s.album_type",
        "agency_id": r.agency,
    }
    return merge(
        "album", delta, ["album_id"], both | {"upd_dt": NOW}, both | same("crt_dt"), name=_n(names, "album")
    )


def album_local(r: Rules, names: Names) -> str:
    if r.regional:
        rule = f"""({fresh('w')} OR w.album_id IN
                    (SELECT y.album_id FROM ted_albumartist y WHERE y.upd_dt > {CUT}))
                   AND w.album_id IN (SELECT album_id FROM {_n(names, 'album')})"""
    else:
        rule = f"w.album_id IN ({generic_ids('album_id', 'ted_album_w', 'ted_albumartist', r.code)})"
    delta = f"""SELECT w.album_id, w.nation_cd AS local_cd, w.title, w.crt_dt, {ok("w.db_sts = 'A'")} AS status
                FROM ted_album_w w WHERE w.nation_cd = '{r.code}' AND {rule}"""
    both = {"title_local": "s.title", "search_title_local": "s.title", "status": "s.status"}
    return merge(
        "album_local", delta, ["album_id", "local_cd"], both | {"upd_dt": NOW}, both | same("crt_dt"),
        name=_n(names, "album_local"),
    )


def track_ids(r: Rules) -> str:
    base = (
        f"OR w.track_id IN (SELECT c.track_id FROM ted_track c WHERE {fresh('c')})" if r.regional else ""
    )
    return f"""SELECT DISTINCT w.track_id FROM ted_track_w w JOIN ted_trackartist x ON x.track_id = w.track_id
               WHERE w.nation_cd = '{r.code}' AND ({fresh('w')} OR x.upd_dt > {CUT} {base})"""


def track(r: Rules, names: Names) -> str:
    if r.regional:
        picked = f"""FROM ted_track b JOIN ted_track_w w ON w.track_id = b.track_id AND w.nation_cd = '{r.code}'
                     WHERE b.track_id IN ({track_ids(r)})
                       AND b.album_id IN (SELECT album_id FROM {_n(names, 'album')})"""
        status = ok("b.db_sts = 'A'", "w.db_sts = 'A'")
    else:
        picked, status = f"FROM ted_track b WHERE b.track_id IN ({track_ids(r)})", ok("b.db_sts = 'A'")
    delta = f"""SELECT b.* EXCLUDE (db_sts), {_first_artist(names, 'ted_trackartist', 'track_id')},
                {status} AS status {picked}"""
    flags = [c for c in TARGETS["track"].names if c.endswith("_yn")]
    plain = [c for c in TARGETS["track"].names if c not in ("track_id", "upd_dt", *flags)]
    both = same(*plain) | {
        c: f"coalesce(s.{'svc_mmp3_yn' if c == 'svc_wma_yn' else c}, 'N')" for c in flags
    }
    return merge("track", delta, ["track_id"], both | {"upd_dt": NOW}, both, name=_n(names, "track"))


def track_local(r: Rules, names: Names) -> str:
    rights = ", ".join(
        f"""coalesce((SELECT x.right_yn FROM ttmp_trackright x
            WHERE x.track_id = w.track_id AND x.service_id = {service}), 'N') AS {kind}_yn"""
        for kind, service in r.services.items()
    )
    parent = f"AND w.track_id IN (SELECT track_id FROM {_n(names, 'track')})" if r.regional else ""
    delta = f"""SELECT w.track_id, w.nation_cd AS local_cd, w.track_title, w.track_title_alt, w.search_title,
                w.crt_dt, {ok("w.db_sts = 'A'")} AS status, {rights}
                FROM ted_track_w w WHERE w.nation_cd = '{r.code}' AND w.track_id IN ({track_ids(r)}) {parent}"""
    inserted = {
        "track_title_local": "s.track_title",
        "crt_dt": "s.crt_dt",
        "status": "s.status",
        "str_rights_yn": "s.str_yn",
        "dnl_rights_yn": "s.dnl_yn",
        "mv_str_rights_yn": "s.str_yn",
    }
    if "rent" in r.services:
        inserted |= {"rent_rights_yn": "s.rent_yn"} | same("track_title_alt", "search_title")
    kept = {"crt_dt"}
    if not r.regional:
        kept.add("status")
    elif r.code == "VNM":
        kept.add("mv_str_rights_yn")
    matched = {c: v for c, v in inserted.items() if c not in kept} | {"upd_dt": NOW}
    return merge(
        "track_local", delta, ["track_id", "local_cd"], matched, inserted, name=_n(names, "track_local")
    )


def _rewritten(table: str, values: Mapping[str, str]) -> str:
    return ", ".join(f"{values.get(c, f't.{c}')} AS {c}" for c in TARGETS[table].names)


def lyrics_type(r: Rules, names: Names) -> str:
    def has(table: str) -> str:
        return f"EXISTS (SELECT 1 FROM {table} x WHERE x.track_id = t.track_id AND x.local_cd = t.local_cd)"

    value = f"""CASE WHEN t.track_id NOT IN ({track_ids(r)}) THEN t.lyrics_tp
                     WHEN {has('time_lyrics')} THEN 'T'
                     WHEN {has('normal_lyrics')} AND t.lyrics_tp IS DISTINCT FROM 'T' THEN 'N'
                     ELSE t.lyrics_tp END"""
    return f"SELECT {_rewritten('track_local', {'lyrics_tp': value})} FROM {_n(names, 'track_local')} t"


def album_style(r: Rules, names: Names) -> str:
    delta = _styles(r, names, "tbm_albumstyle", "ted_album_w", "album_id", "album")
    return merge(
        "album_style", delta, ["album_id", "style_id"], same("listorder"), same("listorder", "crt_dt"),
        name=_n(names, "album_style"),
    )


def track_style(r: Rules, names: Names) -> str:
    styles = _styles(r, names, "tbm_albumstyle", "ted_album_w", "album_id", None)
    delta = f"""SELECT k.track_id, z.style_id, z.listorder, z.crt_dt FROM ({styles}) z
                JOIN {_n(names, 'track')} k ON k.album_id = z.album_id"""
    return merge(
        "track_style", delta, ["track_id", "style_id"], same("listorder"), same("listorder", "crt_dt"),
        name=_n(names, "track_style"),
    )


def blind_mv(r: Rules, names: Names) -> str:
    gone = f"""EXISTS (SELECT 1 FROM ted_mvtrack x WHERE x.mv_id = t.mv_id AND x.track_id = t.track_id
               AND x.db_sts = 'D' AND x.upd_dt > {CUT})"""
    values = {
        "status": f"CASE WHEN {gone} THEN 'BLIND' ELSE t.status END",
        "upd_dt": f"CASE WHEN {gone} THEN {NOW} ELSE t.upd_dt END",
    }
    return f"SELECT {_rewritten('mv', values)} FROM {_n(names, 'mv')} t"


def mv(r: Rules, names: Names) -> str:
    if r.regional:
        links, updated = "ted_mvtrack WHERE db_sts = 'A'", "w.upd_dt"
        picked = f"""JOIN ted_mv_w w ON w.mv_id = b.mv_id AND w.nation_cd = '{r.code}'
                     WHERE {fresh('b', 'w')} OR b.mv_id IN (SELECT y.mv_id FROM ted_mvtrack y WHERE y.upd_dt > {CUT})"""
        status = ok("b.db_sts = 'A'", "w.db_sts = 'A'", "b.svc_aprv_yn = 'Y'")
    else:
        links, updated = "ted_mvtrack", "b.upd_dt"
        picked = f"WHERE b.mv_id IN ({generic_ids('mv_id', 'ted_mv_w', 'ted_mvtrack', r.code)})"
        status = ok("b.db_sts = 'A'")
    delta = f"""SELECT b.* EXCLUDE (upd_dt, high_yn, db_sts), b.high_yn AS highrate_yn, {updated} AS upd_dt,
                k.track_id, k.artist_id, {status} AS status
                FROM ted_mv b
                JOIN (SELECT mv_id, arg_min(track_id, (mvtrack_id, track_id)) AS track_id FROM {links}
                      GROUP BY mv_id) f ON f.mv_id = b.mv_id
                JOIN {_n(names, 'track')} k ON k.track_id = f.track_id {picked}"""
    both = same(*[c for c in TARGETS["mv"].names if c not in ("mv_id", "upd_dt")])
    return merge("mv", delta, ["mv_id"], both | {"upd_dt": NOW}, both | same("upd_dt"), name=_n(names, "mv"))


def mv_local(r: Rules, names: Names) -> str:
    rule = (
        fresh("w")
        if r.regional
        else f"w.mv_id IN ({generic_ids('mv_id', 'ted_mv_w', 'ted_mvtrack', r.code)})"
    )
    delta = f"""SELECT w.mv_id, w.nation_cd AS local_cd, w.mv_title, w.crt_dt, {ok("w.db_sts = 'A'")} AS status
                FROM ted_mv_w w WHERE w.nation_cd = '{r.code}' AND {rule}
                AND w.mv_id IN (SELECT mv_id FROM {_n(names, 'mv')})"""
    both = {"mv_title_local": "s.mv_title", "status": "s.status"}
    once = merge(
        "mv_local", delta, ["mv_id", "local_cd"], both | {"upd_dt": NOW}, both | same("crt_dt"),
        name=_n(names, "mv_local"),
    )
    if r.regional:
        return once
    # merged a second time with the same rows
    return merge(
        "mv_local", delta, ["mv_id", "local_cd"], both | {"upd_dt": NOW}, both | same("crt_dt"), name=f"({once})"
    )


def album_status(r: Rules, names: Names) -> str:
    held = " OR ".join(f"(x.service_id = {s} AND x.right_yn = 'Y')" for s in r.services.values())
    has = f"EXISTS (SELECT 1 FROM ttmp_trackright x WHERE x.album_id = t.album_id AND ({held}))"
    here = f"t.local_cd = '{r.code}'"
    values = {
        "status": f"""CASE WHEN {here} AND NOT {has} THEN 'BLIND'
                           WHEN {here} AND {has} AND t.status <> 'OK' THEN 'OK' ELSE t.status END""",
        "upd_dt": f"""CASE WHEN {here} AND NOT {has} THEN {NOW}
                           WHEN {here} AND {has} AND t.status <> 'OK' THEN {NOW} ELSE t.upd_dt END""",
    }
    return f"SELECT {_rewritten('album_local', values)} FROM {_n(names, 'album_local')} t"


RIGHT_TARGETS = {"str": ["str_rights_yn", "mv_str_rights_yn"], "dnl": ["dnl_rights_yn"], "rent": ["rent_rights_yn"]}


def rights(r: Rules, names: Names, kinds: list[str] | None = None) -> str:
    """One update per kind of right, each reading the result of the one before."""
    relation = _n(names, "track_local")
    for kind in kinds or list(r.services):
        changed = f"""SELECT x.track_id, coalesce(x.right_yn, 'N') AS value FROM ttmp_trackright x
                      WHERE x.service_id = {r.services[kind]} AND {fresh('x')}"""
        hit = f"(t.local_cd = '{r.code}' AND u.track_id IS NOT NULL)"
        values = {c: f"CASE WHEN {hit} THEN u.value ELSE t.{c} END" for c in RIGHT_TARGETS[kind]}
        values["upd_dt"] = f"CASE WHEN {hit} THEN {NOW} ELSE t.upd_dt END"
        body = f"SELECT {_rewritten('track_local', values)} FROM {relation} t LEFT JOIN ({changed}) u ON u.track_id = t.track_id"
        relation = f"({body})"
    return relation.removeprefix("(").removesuffix(")")


def chain(r: Rules, steps: list[tuple[str, str, object]]) -> tuple[dict[str, str], dict[str, str]]:
    """Steps in order as CTEs, each seeing the newest version of every table."""
    names: dict[str, str] = {}
    ctes: dict[str, str] = {}
    for number, (table, label, build) in enumerate(steps):
        body = build(r, names)
        names[table] = f"step{number}_{label}"
        ctes[names[table]] = body
    return ctes, names


def catalog_steps(r: Rules) -> list[tuple[str, str, object]]:
    common = [
        ("artist", "artist", artist),
        ("artist_local", "artist_local", artist_local),
        ("artist_style", "artist_style", artist_style),
        ("album", "album", album),
        ("album_local", "album_local", album_local),
        ("track", "track", track),
        ("track_local", "track_local", track_local),
        ("track_local", "lyrics", lyrics_type),
        ("album_style", "album_style", album_style),
        ("track_style", "track_style", track_style),
    ]
    videos = [("mv", "mv", mv), ("mv_local", "mv_local", mv_local)]
    if not r.regional:
        return common + videos
    return [
        ("genre", "genre", genre),
        ("style", "style", style),
        *common,
        ("mv", "blind_mv", blind_mv),
        *videos,
        ("album_local", "album_status", album_status),
    ]


def rights_steps(r: Rules) -> list[tuple[str, str, object]]:
    return [("track_local", "rights", rights), ("album_local", "album_status", album_status)]


WIDTH = max(len(schema.names) for schema in TARGETS.values())


def all_rows(names: Names) -> str:
    """Every row of every target: its columns as text, in the schema's order."""
    parts = []
    for table, schema in TARGETS.items():
        columns = [f"CAST({c} AS VARCHAR)" for c in schema.names]
        columns += ["CAST(NULL AS VARCHAR)"] * (WIDTH - len(columns))
        listed = ", ".join(f"{c} AS c{i:02d}" for i, c in enumerate(columns))
        parts.append(f"SELECT '{table}' AS target, {listed} FROM {_n(names, table)}")
    return " UNION ALL ".join(parts)
