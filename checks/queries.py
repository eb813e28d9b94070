"""Every registered query with its SQL counterpart."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import partial, reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from checks.oracle import CUT, NOW, RULES, Rules
from checks.standin import AS_OF, given, sources, standin, targets, with_standins
from tidemark.config import JPN, VNM, Region, generic_region
from tidemark.functions.dates import at, changed, cutoff, midnight, stamp14
from tidemark.functions.status import any_right, status_of, yes_no
from tidemark.functions.text import (
    blank_to_null,
    capped,
    first_match,
    joined,
    nth_position,
    piece,
    position,
    replace_pattern,
    replace_text,
    text_before,
)
from tidemark.operators.apply import update_from_lookup, update_if, upsert
from tidemark.operators.changes import changed_ids, changed_since
from tidemark.operators.joins import first_child, has_parent, lacks, lookup_one, top1, with_exists_flag
from tidemark.operators.rows import fields_to_columns, split_rows
from tidemark.operators.trees import tree_children, tree_roots
from tidemark.plans import albums, artists, genres, rights, tracks, videos
from tidemark.plans.context import Run, Tables, same_named
from tidemark.plans.ddl_text import index_ddl_extract, reload_index_ddl
from tidemark.plans.logins import ingest_logins, is_mobile, parse_client, valid_client
from tidemark.plans.runner import sync_catalog, sync_rights
from tidemark.schemas import INDEX_DDL, LOGIN_LOG, TARGETS
from tidemark.sources.catalog import load_sources
from tidemark.sources.file_dates import date_columns
from tidemark.sources.parallel import side_by_side
from tidemark.sources.sinks import append_once, append_rows, ensure_batch_table, ensure_table, fill_columns, is_empty, truncate_reload
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.staging import Staging, shared_folder
from tidemark.streaming.logins import ingest_logins_into, ingest_logins_stream, read_login_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CUTOFF = cutoff(AS_OF)


def _register(name: str, sql: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        ORACLES[name] = with_standins(sql)
        return build

    return add


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/checks-{uuid.uuid4().hex}"


# --- change capture -------------------------------------------------------------------


@_register(
    "changed_since",
    f"SELECT track_id, crt_dt, upd_dt FROM ted_track WHERE crt_dt > {CUT} OR upd_dt > {CUT}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return changed_since(standin(spark, sf, "ted_track"), CUTOFF).select("track_id", "crt_dt", "upd_dt")


@_register(
    "changed_since_one_date",
    f"SELECT artist_id, style_id, listorder FROM tbm_artiststyle WHERE crt_dt > {CUT}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    styles = standin(spark, sf, "tbm_artiststyle")
    return changed_since(styles, CUTOFF, ("crt_dt",)).select("artist_id", "style_id", "listorder")


@_register(
    "changed_scan",
    "SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem WHERE l_shipdate > TIMESTAMP '2000-06-14 00:00:00'",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return changed_since(given(spark, sf, "lineitem"), CUTOFF, ("l_shipdate",)).select(
        "l_orderkey", "l_partkey", "l_shipdate"
    )


def _by_files(spark: SparkSession, sf: str, names: Sequence[str]) -> Tables:
    """Replicas in files by date, with the dates of each; the later half arrives after a first load.

    There are as many files as the rows need; a date that more rows have than one takes goes to several.
    """
    root, dates_root = _new_folder(spark), _new_folder(spark)
    for later in (False, True):
        for name in names:
            rows = standin(spark, sf, name)
            date = F.coalesce(*[F.col(c) for c in reversed(date_columns(rows.schema))])
            arrives = F.coalesce(date > at(_HALF), F.lit(False)) == later
            load = rows.where(arrives)
            files = max(8, -(-load.count() // _FILE_ROWS))
            split = load.repartitionByRange(files, date, F.xxhash64(*rows.columns))
            split.write.mode("append").parquet(f"{root}/{name}")
        src = load_sources(spark, root, names=names, dates_root=dates_root)
    return src


_HALF = datetime(1997, 1, 1)
_FILE_ROWS = 500_000


@_register(
    "changed_since_by_files",
    f"SELECT track_id, nation_cd, crt_dt, upd_dt FROM ted_track_w WHERE crt_dt > {CUT} OR upd_dt > {CUT}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    src = _by_files(spark, sf, ["ted_track_w"])
    rows = changed_since(src.since("ted_track_w", CUTOFF), CUTOFF)
    return rows.select("track_id", "nation_cd", "crt_dt", "upd_dt")


@_register("changed_tracks_by_files", oracle.track_ids(RULES["vnm"]))
def _(spark: SparkSession, sf: str) -> DataFrame:
    src = _by_files(spark, sf, ["ted_track", "ted_track_w", "ted_trackartist"])
    return tracks.changed_tracks(src, Run.start(spark, VNM, AS_OF))


@_register(
    "changed_ids",
    f"""SELECT DISTINCT w.track_id FROM ted_track_w w, ted_trackartist x
        WHERE w.track_id = x.track_id AND (w.crt_dt > {CUT} OR w.upd_dt > {CUT} OR x.upd_dt > {CUT})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return changed_ids(
        standin(spark, sf, "ted_track_w"),
        standin(spark, sf, "ted_trackartist"),
        None,
        "track_id",
        CUTOFF,
        Staging(spark),
    )


for _label, _region in (("vnm", VNM), ("jpn", JPN), ("generic", generic_region())):

    @_register(f"changed_tracks_{_label}", oracle.track_ids(RULES[_label]))
    def _(spark: SparkSession, sf: str, region: Region = _region) -> DataFrame:
        return tracks.changed_tracks(sources(spark, sf), Run.start(spark, region, AS_OF))


@_register(
    "changed_or_child_changed",
    """SELECT o_orderkey, o_custkey FROM orders o WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'
       OR EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                  AND l.l_shipdate > TIMESTAMP '2001-01-01 00:00:00')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    day = F.lit("2001-01-01").cast("timestamp_ntz")
    orders = given(spark, sf, "orders")
    shipped = given(spark, sf, "lineitem").where(F.col("l_shipdate") > day)
    shipped = shipped.select(F.col("l_orderkey").alias("o_orderkey"))
    flagged = with_exists_flag(orders, shipped, ["o_orderkey"], "shipped")
    return flagged.where((F.col("o_orderdate") > day) | F.col("shipped")).select("o_orderkey", "o_custkey")


@_register(
    "exists_flag",
    """SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                                  AND l.l_returnflag = 'R') AS returned FROM orders o""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    returned = given(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    returned = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    orders = given(spark, sf, "orders").select("o_orderkey")
    return with_exists_flag(orders, returned, ["o_orderkey"], "returned")


# --- joins ----------------------------------------------------------------------------


@_register(
    "inner_join",
    """SELECT b.album_id, b.title, w.nation_cd, w.title AS title_w FROM ted_album b
       JOIN ted_album_w w ON w.album_id = b.album_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    region = standin(spark, sf, "ted_album_w").select("album_id", "nation_cd", F.col("title").alias("title_w"))
    return standin(spark, sf, "ted_album").select("album_id", "title").join(region, "album_id")


@_register(
    "multiway_join",
    """SELECT l.l_partkey, l.l_orderkey, l.l_linenumber, o.o_custkey, p.p_name, s.s_name FROM lineitem l
       JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
       JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE o.o_orderstatus = 'F'""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    orders = given(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return (
        given(spark, sf, "lineitem")
        .join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
        .join(given(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
        .join(given(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")
        .select("l_partkey", "l_orderkey", "l_linenumber", "o_custkey", "p_name", "s_name")
    )


@_register(
    "style_expansion",
    """SELECT k.track_id, x.style_id, x.listorder FROM tbm_albumstyle x JOIN track k ON k.album_id = x.album_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    album_tracks = standin(spark, sf, "track").select("track_id", "album_id")
    return (
        standin(spark, sf, "tbm_albumstyle")
        .join(album_tracks, "album_id")
        .select("track_id", "style_id", "listorder")
    )


@_register(
    "semi_parent",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
       WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    open_orders = given(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    parent = open_orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return has_parent(
        given(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), parent, ["l_orderkey"]
    )


@_register(
    "stacked_semi",
    """SELECT x.album_id, x.style_id FROM tbm_albumstyle x
       WHERE x.album_id IN (SELECT album_id FROM album) AND x.style_id IN (SELECT style_id FROM style)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = standin(spark, sf, "tbm_albumstyle").select("album_id", "style_id")
    rows = has_parent(rows, standin(spark, sf, "album"), ["album_id"])
    return has_parent(rows, standin(spark, sf, "style"), ["style_id"])


@_register(
    "filtered_semi",
    """SELECT x.artist_id, x.style_id FROM tbm_artiststyle x WHERE EXISTS
       (SELECT 1 FROM ted_artist_w w WHERE w.artist_id = x.artist_id AND w.nation_cd = 'JPN')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    region = standin(spark, sf, "ted_artist_w").where(F.col("nation_cd") == "JPN")
    rows = standin(spark, sf, "tbm_artiststyle").select("artist_id", "style_id")
    return has_parent(rows, region, ["artist_id"])


@_register(
    "composite_semi",
    """SELECT t.track_id, t.local_cd, t.lyrics_tp FROM track_local t WHERE EXISTS
       (SELECT 1 FROM time_lyrics x WHERE x.track_id = t.track_id AND x.local_cd = t.local_cd)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = standin(spark, sf, "track_local").select("track_id", "local_cd", "lyrics_tp")
    return has_parent(rows, standin(spark, sf, "time_lyrics"), ["track_id", "local_cd"])


@_register(
    "semi_many",
    """SELECT o_orderkey, o_custkey FROM orders o WHERE EXISTS
       (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linestatus = 'O')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = given(spark, sf, "lineitem").where(F.col("l_linestatus") == "O")
    lines = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    orders = given(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return has_parent(orders, lines, ["o_orderkey"], unique=False)


@_register(
    "anti_no_rights",
    """SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS
       (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
        AND ((l.l_linenumber = 1 AND l.l_returnflag = 'A') OR (l.l_linenumber = 2 AND l.l_returnflag = 'A')))""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = given(spark, sf, "lineitem").where(
        F.col("l_linenumber").isin(1, 2) & (F.col("l_returnflag") == "A")
    )
    lines = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    return lacks(given(spark, sf, "orders").select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@_register(
    "any_right",
    """SELECT track_id, service_id FROM ttmp_trackright
       WHERE (service_id = 716 AND right_yn = 'Y') OR (service_id = 717 AND right_yn = 'Y')
          OR (service_id = 718 AND right_yn = 'Y')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = standin(spark, sf, "ttmp_trackright")
    return rows.where(any_right(JPN.services)).select("track_id", "service_id")


@_register(
    "lookup_one",
    """SELECT a.artist_id, (SELECT x.site_url FROM tfm_website x
       WHERE x.rel_entity_cd = 'ted_artist' AND x.rel_id = a.artist_id) AS homepage_url FROM ted_trackartist a""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    sites = standin(spark, sf, "tfm_website").where(F.col("rel_entity_cd") == "ted_artist")
    sites = sites.select(F.col("rel_id").alias("artist_id"), "site_url")
    rows = standin(spark, sf, "ted_trackartist").select("artist_id")
    return lookup_one(rows, sites, ["artist_id"], "site_url", "homepage_url", stage=Staging(spark))


@_register(
    "lookup_default",
    """SELECT o_orderkey, coalesce((SELECT min(l.l_returnflag) FROM lineitem l
       WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = 1), 'N') AS flag FROM orders o""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    first_lines = given(spark, sf, "lineitem").where(F.col("l_linenumber") == 1)
    single = first_lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_returnflag").alias("right_yn")
    )
    orders = given(spark, sf, "orders").select("o_orderkey")
    return lookup_one(orders, single, ["o_orderkey"], "right_yn", "flag", "N")


@_register(
    "first_child",
    """SELECT o_orderkey, (SELECT min(l.l_suppkey) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
       AND l.l_linestatus = 'F' AND EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey
                                            AND s.s_acctbal > 5000)) AS l_suppkey FROM orders o""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    parent = given(spark, sf, "supplier").where(F.col("s_acctbal") > 5000)
    return first_child(
        given(spark, sf, "orders").select("o_orderkey"),
        given(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey",
        "l_suppkey",
        F.col("l_linestatus") == "F",
        parent.select(F.col("s_suppkey").alias("l_suppkey")),
    )


@_register(
    "top1_per_group",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate FROM
       (SELECT *, row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_suppkey, l_partkey, l_shipdate) AS rn FROM lineitem) r WHERE rn = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    order = ["l_linenumber", "l_suppkey", "l_partkey", "l_shipdate"]
    lines = given(spark, sf, "lineitem").select("l_orderkey", *order)
    return top1(lines, ["l_orderkey"], order)


@_register(
    "first_track_of_mv",
    """SELECT mv_id, track_id FROM (SELECT *, row_number() OVER (PARTITION BY mv_id
       ORDER BY mvtrack_id, track_id) AS rn FROM ted_mvtrack WHERE db_sts = 'A') r WHERE rn = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return videos.first_track_of_mv(standin(spark, sf, "ted_mvtrack").where(F.col("db_sts") == "A"))


@_register("tree_roots", "SELECT genre_cd, genre_nm FROM tmu_genre WHERE genre_cd = pgenre_cd")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tree_roots(standin(spark, sf, "tmu_genre"), "genre_cd", "pgenre_cd").select("genre_cd", "genre_nm")


@_register("tree_children", "SELECT genre_cd, pgenre_cd, genre_nm FROM tmu_genre WHERE genre_cd <> pgenre_cd")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tree_children(standin(spark, sf, "tmu_genre"), "genre_cd", "pgenre_cd")


# --- expressions ----------------------------------------------------------------------


@_register(
    "status_decode",
    """SELECT o_orderkey, CASE nullif(o_orderstatus, 'P') WHEN 'F' THEN 'OK' ELSE 'BLIND' END AS status,
       coalesce(nullif(o_orderstatus, 'P'), 'N') AS flag FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    code = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    active = F.when(code == "F", "A").when(code == "O", "D")
    return given(spark, sf, "orders").select("o_orderkey", status_of(active).alias("status"), yes_no(code).alias("flag"))


@_register(
    "status_two_way",
    """SELECT b.track_id, w.nation_cd, CASE WHEN concat(b.db_sts, w.db_sts) = 'AA' THEN 'OK' ELSE 'BLIND' END AS status
       FROM ted_track b JOIN ted_track_w w ON w.track_id = b.track_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    region = standin(spark, sf, "ted_track_w").select("track_id", "nation_cd", F.col("db_sts").alias("w_db_sts"))
    rows = standin(spark, sf, "ted_track").join(region, "track_id")
    return rows.select("track_id", "nation_cd", status_of("db_sts", "w_db_sts").alias("status"))


@_register(
    "status_three_way",
    """SELECT b.album_id, w.nation_cd,
       CASE WHEN concat(b.db_sts, w.db_sts, coalesce(b.svc_aprv_yn, 'N')) = 'AAY' THEN 'OK' ELSE 'BLIND' END AS status
       FROM ted_album b JOIN ted_album_w w ON w.album_id = b.album_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    region = standin(spark, sf, "ted_album_w").select("album_id", "nation_cd", F.col("db_sts").alias("w_db_sts"))
    rows = standin(spark, sf, "ted_album").drop("nation_cd").join(region, "album_id")
    status = status_of("db_sts", "w_db_sts", approved="svc_aprv_yn")
    return rows.select("album_id", "nation_cd", status.alias("status"))


@_register(
    "null_guards",
    """SELECT track_id, local_cd, lyrics_tp FROM track_local
       WHERE (lyrics_tp IS NULL OR lyrics_tp <> 'T') AND nullif(status, 'OK') <> 'OK'""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    not_timed = F.col("lyrics_tp").isNull() | (F.col("lyrics_tp") != "T")
    not_ok = F.nullif(F.col("status"), F.lit("OK")) != "OK"
    return standin(spark, sf, "track_local").where(not_timed & not_ok).select("track_id", "local_cd", "lyrics_tp")


@_register(
    "text_functions",
    """SELECT event_id,
       nullif(concat(event_type, nullif(txt, '')), '') AS joined_text,
       nullif(regexp_extract(txt, '[0-9]+'), '') AS first_number,
       nullif(regexp_replace(txt, '[a-c]', '*', 'g'), '') AS starred,
       nullif(replace(txt, ',', ''), '') AS without_commas,
       nullif(substr(txt, 3, 4), '') AS middle,
       nullif(CASE WHEN length(txt) - 8 > 0 THEN substr(txt, 1, length(txt) - 8) END, '') AS all_but_8,
       instr(txt, ',') AS comma_1,
       CASE WHEN txt IS NULL THEN NULL WHEN len(string_split(txt, ',')) < 3 THEN 0
            ELSE length(array_to_string(list_slice(string_split(txt, ','), 1, 2), ',')) + 1 END AS comma_2,
       length(txt) AS n_chars,
       nullif(CASE WHEN instr(txt, ',') > 0 THEN substr(txt, 1, instr(txt, ',') - 1) END, '') AS before_comma,
       nullif(substr(txt, 1, 5), '') AS capped_5
       FROM fields JOIN events USING (event_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = standin(spark, sf, "fields").join(given(spark, sf, "events").select("event_id", "event_type"), "event_id")
    return rows.select(
        "event_id",
        joined("event_type", blank_to_null("txt")).alias("joined_text"),
        first_match("txt", "[0-9]+").alias("first_number"),
        replace_pattern("txt", "[a-c]", "*").alias("starred"),
        replace_text("txt", ",").alias("without_commas"),
        piece("txt", 3, 4).alias("middle"),
        piece("txt", 1, F.length("txt") - 8).alias("all_but_8"),
        position("txt", ",").cast("bigint").alias("comma_1"),
        nth_position("txt", ",", 2).cast("bigint").alias("comma_2"),
        F.length("txt").cast("bigint").alias("n_chars"),
        text_before("txt", ",").alias("before_comma"),
        capped("txt", 5).alias("capped_5"),
    )


@_register(
    "text_before",
    """SELECT doc_id, CASE WHEN instr(text, ' the ') > 1 THEN substr(text, 1, instr(text, ' the ') - 1) END AS head,
       length(text) AS n FROM documents""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    documents = given(spark, sf, "documents")
    return documents.select(
        "doc_id", text_before("text", " the ").alias("head"), F.length("text").cast("bigint").alias("n")
    )


@_register(
    "date_functions",
    f"""SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS day, strftime(ts, '%Y%m%d%H%M%S') AS stamp,
        ts > date_trunc('day', TIMESTAMP '2024-01-10 09:00:00' - INTERVAL 1 DAY) AS is_new, {NOW} AS run_at FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    day_before = cutoff(AS_OF.replace(year=2024, month=1, day=10))
    return given(spark, sf, "events").select(
        "event_id",
        midnight("ts").alias("day"),
        stamp14("ts").alias("stamp"),
        changed(day_before, "ts").alias("is_new"),
        at(AS_OF).alias("run_at"),
    )


# --- separated text -------------------------------------------------------------------


@_register(
    "split_rows",
    """SELECT event_id, CAST(field_no AS BIGINT) AS field_no, nullif(parts[field_no], '') AS txt FROM
       (SELECT event_id, parts, unnest(range(1, len(parts) + 1)) AS field_no FROM
        (SELECT event_id, string_split(coalesce(txt, ''), ',') AS parts FROM fields) a) b""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = split_rows(standin(spark, sf, "fields"), "txt")
    return rows.withColumn("field_no", F.col("field_no").cast("bigint"))


@_register(
    "fields_to_columns",
    """SELECT event_id, nullif(substr(parts[1], 1, 4), '') AS kind, nullif(substr(parts[3], 1, 50), '') AS props,
       nullif(substr(parts[5], 1, 50), '') AS fifth FROM
       (SELECT event_id, string_split(coalesce(txt, ''), ',') AS parts FROM fields) a""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    spec = {"kind": (1, 4), "props": (3, 50), "fifth": (5, 50)}
    return fields_to_columns(standin(spark, sf, "fields"), "txt", spec).drop("txt")


# --- upsert and updates ---------------------------------------------------------------


def _existing_orders(spark: SparkSession, sf: str) -> DataFrame:
    old = given(spark, sf, "orders").where(F.col("o_orderkey") % 3 != 0)
    return old.select(
        F.col("o_orderkey").alias("track_id"),
        F.lit("old").alias("title"),
        F.col("o_orderdate").alias("crt_dt"),
        F.lit(None).cast("timestamp_ntz").alias("upd_dt"),
        F.lit("BLIND").alias("status"),
        F.lit("x").alias("kept"),
    )


@_register(
    "upsert_orders",
    oracle.merge(
        "orders",
        """SELECT o_orderkey AS track_id, o_orderpriority AS title, o_orderdate AS crt_dt,
           CASE o_orderstatus WHEN 'F' THEN 'OK' ELSE 'BLIND' END AS status FROM orders
           WHERE o_orderdate > TIMESTAMP '2000-06-14 00:00:00'""",
        ["track_id"],
        oracle.same("title", "status") | {"upd_dt": NOW},
        oracle.same("title", "crt_dt", "status"),
        columns=["track_id", "title", "crt_dt", "upd_dt", "status", "kept"],
        name="""(SELECT o_orderkey AS track_id, 'old' AS title, o_orderdate AS crt_dt, CAST(NULL AS TIMESTAMP) AS upd_dt,
                 'BLIND' AS status, 'x' AS kept FROM orders WHERE o_orderkey % 3 <> 0)""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    active = F.when(F.col("o_orderstatus") == "F", "A")
    delta = changed_since(given(spark, sf, "orders"), CUTOFF, ("o_orderdate",)).select(
        F.col("o_orderkey").alias("track_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("crt_dt"),
        status_of(active).alias("status"),
    )
    return upsert(
        _existing_orders(spark, sf),
        Staging(spark)(delta, "orders"),
        ["track_id"],
        on_match=same_named("title", "status") | {"upd_dt": at(AS_OF)},
        on_insert=same_named("title", "crt_dt", "status"),
    )


@_register(
    "upsert_composite_key",
    oracle.merge(
        "track_local",
        f"""SELECT w.track_id, w.nation_cd AS local_cd, w.track_title FROM ted_track_w w WHERE {oracle.fresh('w')}""",
        ["track_id", "local_cd"],
        {"track_title_local": "s.track_title", "upd_dt": NOW},
        {"track_title_local": "s.track_title"},
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = changed_since(standin(spark, sf, "ted_track_w"), CUTOFF)
    delta = rows.select("track_id", F.col("nation_cd").alias("local_cd"), "track_title")
    title = {"track_title_local": "src.track_title"}
    return upsert(
        standin(spark, sf, "track_local"),
        Staging(spark)(delta, "titles"),
        ["track_id", "local_cd"],
        on_match=title | {"upd_dt": at(AS_OF)},
        on_insert=title,
    )


def _flagged_orders(condition: str) -> str:
    return f"""SELECT o_orderkey, CASE WHEN {condition} THEN 'BLIND' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN {condition} THEN {NOW} ELSE o_orderdate END AS o_orderdate FROM orders o"""


_RETURNED = "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')"


def _update_orders(spark: SparkSession, sf: str, exists: bool, guard: bool) -> DataFrame:
    returned = given(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return update_if(
        given(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"),
        returned.select(F.col("l_orderkey").alias("o_orderkey")),
        ["o_orderkey"],
        {"o_orderstatus": F.lit("BLIND"), "o_orderdate": at(AS_OF)},
        guard=F.col("o_orderstatus") != "F" if guard else None,
        exists=exists,
    )


@_register("update_if_exists", _flagged_orders(f"{_RETURNED} AND o.o_orderstatus <> 'F'"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _update_orders(spark, sf, exists=True, guard=True)


@_register("update_if_not_exists", _flagged_orders(f"NOT {_RETURNED}"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _update_orders(spark, sf, exists=False, guard=False)


@_register(
    "update_from_lookup",
    f"""SELECT t.album_id, CASE WHEN s.album_id IS NOT NULL AND t.status = 'OK' THEN s.title ELSE t.title END AS title,
        t.status FROM album t LEFT JOIN ted_album s ON s.album_id = t.album_id AND {oracle.fresh('s')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    lookup = changed_since(standin(spark, sf, "ted_album"), CUTOFF).select("album_id", "title")
    album = standin(spark, sf, "album").select("album_id", "title", "status")
    return update_from_lookup(album, lookup, ["album_id"], {"title": "src.title"}, guard=F.col("status") == "OK")


# --- steps of the catalogue sync ------------------------------------------------------

Step = Callable[[Tables, Tables, Run], DataFrame]
BOTH = ("vnm", "jpn")
ALL = (*BOTH, "generic", "generic_jpn")
# Names without a region, given when only one was registered.
PLAIN = ("genre", "style", "blind_deleted_mv")
REGIONS = {"vnm": VNM, "jpn": JPN, "generic": generic_region(), "generic_jpn": generic_region("JPN")}

STEPS: list[tuple[str, Step, Callable[[Rules, dict[str, str]], str], tuple[str, ...]]] = [
    ("genre", genres.sync_genre, oracle.genre, BOTH),
    ("style", genres.sync_style, oracle.style, BOTH),
    ("artist", artists.sync_artist, oracle.artist, ALL),
    ("artist_local", artists.sync_artist_local, oracle.artist_local, ALL),
    ("artist_style", artists.sync_artist_style, oracle.artist_style, ALL),
    ("album", albums.sync_album, oracle.album, ALL),
    ("album_local", albums.sync_album_local, oracle.album_local, ALL),
    ("track", tracks.sync_track, oracle.track, ALL),
    ("track_local", tracks.sync_track_local, oracle.track_local, ALL),
    ("lyrics_type", tracks.sync_lyrics_type, oracle.lyrics_type, ALL),
    ("album_style", albums.sync_album_style, oracle.album_style, ALL),
    ("track_style", albums.sync_track_style, oracle.track_style, ALL),
    ("blind_deleted_mv", videos.blind_deleted_mv, oracle.blind_mv, BOTH),
    ("mv", videos.sync_mv, oracle.mv, ALL),
    ("mv_local", videos.sync_mv_local, oracle.mv_local, ALL),
    ("album_status", albums.album_status_by_rights, oracle.album_status, BOTH),
    ("stream_rights", rights.sync_stream_rights, partial(oracle.rights, kinds=["str"]), BOTH),
    ("download_rights", rights.sync_download_rights, partial(oracle.rights, kinds=["dnl"]), BOTH),
    ("rental_rights", rights.sync_rental_rights, partial(oracle.rights, kinds=["rent"]), ("jpn",)),
    ("track_rights", rights.sync_track_rights, oracle.rights, BOTH),
]


def _run_step(spark: SparkSession, sf: str, step: Step, region: Region) -> DataFrame:
    return step(sources(spark, sf), targets(spark, sf), Run.start(spark, region, AS_OF))


for _name, _step, _sql, _labels in STEPS:
    for _label in _labels:
        _key = f"sync_{_name}" if _name in PLAIN and _label == "vnm" else f"sync_{_name}_{_label}"
        QUERIES[_key] = partial(_run_step, step=_step, region=REGIONS[_label])
        ORACLES[_key] = with_standins(_sql(RULES[_label], {}))


# --- whole jobs -----------------------------------------------------------------------


def _all_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of every target, its columns as text."""

    def one(name: str) -> DataFrame:
        columns = [F.col(c).cast("string") for c in TARGETS[name].names]
        columns += [F.lit(None).cast("string")] * (oracle.WIDTH - len(columns))
        return tables[name].select(F.lit(name).alias("target"), *[c.alias(f"c{i:02d}") for i, c in enumerate(columns)])

    return reduce(DataFrame.unionAll, [one(name) for name in TARGETS])


def _run_job(spark: SparkSession, sf: str, job: Callable, region: Region, ids_per_part: Sequence[int]) -> DataFrame:
    """A seeded store after one run for each setting it is opened with."""
    root = _new_folder(spark)
    Snapshots(spark, root, ids_per_part[0]).seed(targets(spark, sf))
    for ids in ids_per_part:
        job(spark, sources(spark, sf), Snapshots(spark, root, ids), region, AS_OF)
    store = Snapshots(spark, root)
    _, folders = store.published()
    return _all_rows(store.read(folders))


def _register_job(name: str, job: Callable, label: str, steps: Callable, ids_per_part: Sequence[int] = (1_000_000,)) -> None:
    ctes, names = oracle.chain(RULES[label], steps(RULES[label]) * len(ids_per_part))
    QUERIES[name] = partial(_run_job, job=job, region=REGIONS[label], ids_per_part=ids_per_part)
    ORACLES[name] = with_standins(oracle.all_rows(names), ctes)


for _label in ALL:
    _register_job(f"catalog_{_label}", sync_catalog, _label, oracle.catalog_steps)
for _label in BOTH:
    _register_job(f"rights_{_label}", sync_rights, _label, oracle.rights_steps)
_register_job("store_reopened", sync_catalog, "generic", oracle.catalog_steps, (1_000, 7))

_SCATTERED = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15)) AS BIGINT)"


@_register(
    "store_scattered_ids",
    f"""SELECT {_SCATTERED} AS mv_id,
               CASE WHEN o_orderkey % 10 = 0 THEN 'new' ELSE o_orderstatus END AS mv_title
        FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 4 < 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed ids: most are there before a change that brings a tenth of all."""
    orders = given(spark, sf, "orders")
    scattered = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15), 16, 10).cast("long")
    rows = orders.select(F.col("o_orderkey").alias("key"), scattered.alias("mv_id"), F.col("o_orderstatus").alias("mv_title"))
    store = Snapshots(spark, _new_folder(spark))
    store.seed({"mv": fill_columns(rows.where("key % 4 < 3").drop("key"), TARGETS["mv"])})
    run, folders = store.published()
    fresh = Staging(spark)(rows.where("key % 10 = 0").select("mv_id", F.lit("new").alias("mv_title")), "fresh")
    before = store.read_table("mv", folders, store.parts_of("mv", fresh))
    after = upsert(before, fresh, ["mv_id"], same_named("mv_title"), same_named("mv_title"))
    folders.update(store.write(after, "mv", store.new_version(run + 1)))
    store.publish(folders, run + 1)
    return store.read_table("mv", store.published()[1]).select("mv_id", "mv_title")


@_register(
    "store_scattered_changes",
    f"""SELECT {_SCATTERED} AS mv_id,
               CASE WHEN o_orderkey % 15 = 0 THEN 'newer' WHEN o_orderkey % 10 = 0 THEN 'new' ELSE o_orderstatus END AS mv_title
        FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 15 = 0 OR o_orderkey % 4 < 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed ids changed twice, beside the base files; some parts are folded in between."""
    orders = given(spark, sf, "orders")
    scattered = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15), 16, 10).cast("long")
    rows = orders.select(F.col("o_orderkey").alias("key"), scattered.alias("mv_id"), F.col("o_orderstatus").alias("mv_title"))
    store, stage = Snapshots(spark, _new_folder(spark)), Staging(spark)
    store.seed({"mv": fill_columns(rows.where("key % 4 < 3").drop("key"), TARGETS["mv"])})
    for every, title in ((10, "new"), (15, "newer")):
        run, version = store.published()
        fresh = stage(rows.where(F.col("key") % every == 0).select("mv_id", F.lit(title).alias("mv_title")), title)
        before = store.read_for("mv", version, store.parts_of("mv", fresh), fresh)
        after = upsert(before, fresh, ["mv_id"], same_named("mv_title"), same_named("mv_title"))
        written = store.write(after, "mv", store.new_version(run + 1))
        store.publish_over(run, version, [(written, True)], written)
        if title == "new":
            store.fold(ratio=0.9)
    return store.read_table("mv", store.published()[1]).select("mv_id", "mv_title")


def _chained(runs: Sequence[tuple[str, Callable, datetime, datetime]]) -> str:
    """SQL of all targets after jobs one after another, each with its run time and its cut."""
    names: dict[str, str] = {}
    ctes: dict[str, str] = {}
    for label, steps, as_of, cut in runs:
        for table, step, build in steps(RULES[label]):
            body = build(RULES[label], names)
            body = body.replace(CUT, f"TIMESTAMP '{cut:%Y-%m-%d %H:%M:%S}'").replace(NOW, f"TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}'")
            names[table] = f"step{len(ctes)}_{step}"
            ctes[names[table]] = body
    return with_standins(oracle.all_rows(names), ctes)


_EARLIER = AS_OF - timedelta(days=200)


def _store_missed_day(spark: SparkSession, sf: str) -> DataFrame:
    """Rights of one region, with no run on the days between two: the second goes back to the first."""
    store = Snapshots(spark, _new_folder(spark), 1_000_000)
    store.seed(targets(spark, sf))
    for as_of in (_EARLIER, AS_OF):
        sync_rights(spark, sources(spark, sf), store, REGIONS["jpn"], as_of)
    return _all_rows(store.read(store.published()[1]))


def _store_disjoint_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Rights of two regions at the same time, both from one version of the store."""
    root = _new_folder(spark)
    Snapshots(spark, root, 1_000_000).seed(targets(spark, sf))
    src = sources(spark, sf)
    runs = [partial(sync_rights, spark, src, Snapshots(spark, root), REGIONS[label], AS_OF) for label in ("vnm", "jpn")]
    side_by_side(spark, *runs)
    store = Snapshots(spark, root)
    return _all_rows(store.read(store.published()[1]))


QUERIES["store_missed_day"] = _store_missed_day
ORACLES["store_missed_day"] = _chained(
    [("jpn", oracle.rights_steps, _EARLIER, cutoff(_EARLIER)), ("jpn", oracle.rights_steps, AS_OF, cutoff(_EARLIER, 0))]
)
QUERIES["store_disjoint_runs"] = _store_disjoint_runs
ORACLES["store_disjoint_runs"] = _chained([(label, oracle.rights_steps, AS_OF, CUTOFF) for label in ("vnm", "jpn")])


# --- sources and sinks ----------------------------------------------------------------


@_register(
    "load_sources",
    """SELECT w.track_id, w.nation_cd, w.track_title, w.upd_dt FROM ted_track_w w
       JOIN time_lyrics x ON x.track_id = w.track_id AND x.local_cd = w.nation_cd""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    root, lyrics_root = _new_folder(spark), _new_folder(spark)
    standin(spark, sf, "ted_track_w").write.parquet(f"{root}/ted_track_w")
    standin(spark, sf, "time_lyrics").write.parquet(f"{lyrics_root}/time_lyrics")
    src = load_sources(spark, root, lyrics_root, ["ted_track_w", "time_lyrics"])
    lyrics = src["time_lyrics"].withColumnRenamed("local_cd", "nation_cd")
    rows = src["ted_track_w"].join(lyrics, ["track_id", "nation_cd"])
    return rows.select("track_id", "nation_cd", "track_title", "upd_dt")


@_register(
    "is_empty",
    """SELECT o_orderstatus, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') = 0 AS none_returned,
       (SELECT count(*) FROM lineitem WHERE l_returnflag = '?') = 0 AS none_odd, count(*) AS n
       FROM orders GROUP BY o_orderstatus""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = given(spark, sf, "lineitem")
    flags = {"none_returned": "R", "none_odd": "?"}
    return given(spark, sf, "orders").groupBy("o_orderstatus").agg(
        *[F.lit(is_empty(lines.where(F.col("l_returnflag") == f))).alias(n) for n, f in flags.items()],
        F.count(F.lit(1)).alias("n"),
    )


def _sink(spark: SparkSession, label: str) -> tuple[str, str]:
    return f"{label}_{uuid.uuid4().hex}", _new_folder(spark)


@_register(
    "append_rows",
    """SELECT event_id AS msrl, user_id AS sso_srl, CAST(NULL AS VARCHAR) AS login_ip1, 'W' AS login_tp,
       strftime(ts, '%Y%m%d%H%M%S') AS login_dt, CAST(NULL AS VARCHAR) AS m_exception FROM events
       UNION ALL SELECT event_id, user_id, NULL, 'X', NULL, event_type FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    name, folder = _sink(spark, "login_log")
    ensure_table(spark, name, LOGIN_LOG, location=folder)
    events = given(spark, sf, "events")
    ids = [F.col("event_id").alias("msrl"), F.col("user_id").alias("sso_srl")]
    append_rows(events.select(*ids, F.lit("W").alias("login_tp"), stamp14("ts").alias("login_dt")), name)
    append_rows(events.select(*ids, F.lit("X").alias("login_tp"), F.col("event_type").alias("m_exception")), name)
    return spark.table(name).select("msrl", "sso_srl", "login_ip1", "login_tp", "login_dt", "m_exception")


@_register(
    "append_once",
    "SELECT event_id AS msrl, user_id AS sso_srl, event_type AS m_exception, CAST(event_id % 3 AS VARCHAR) AS batch FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads, each handed over twice, the second time with other rows as well."""
    name, folder = _sink(spark, "login_log")
    ensure_batch_table(spark, name, LOGIN_LOG, folder)
    events = given(spark, sf, "events").select(
        F.col("event_id").alias("msrl"), F.col("user_id").alias("sso_srl"), F.col("event_type").alias("m_exception")
    )
    for load in range(3):
        append_once(events.where(F.col("msrl") % 3 == load), name, str(load))
        append_once(events, name, str(load))
    return spark.table(name).select("msrl", "sso_srl", "m_exception", "batch")


@_register("truncate_reload_from_itself", "SELECT ddl AS contents_1 FROM ddl_text WHERE ddl IS NOT NULL")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A reload that reads the table it replaces, after one that failed midway."""
    name, folder = _sink(spark, "index_ddl")
    ensure_table(spark, name, INDEX_DDL, location=folder)
    truncate_reload(standin(spark, sf, "ddl_text").select(F.col("ddl").alias("contents_1")), name)
    broken = F.when(F.col("contents_1").isNull(), F.raise_error(F.lit("broken")).cast("string")).otherwise(F.lit("x"))
    try:
        truncate_reload(spark.table(name).select(broken.alias("contents_1")), name)
    except PySparkException:
        pass  # the rows before it are still there
    truncate_reload(spark.table(name).where(F.col("contents_1").isNotNull()), name)
    return spark.table(name)


@_register("truncate_reload", "SELECT ddl AS contents_1 FROM ddl_text WHERE ddl IS NOT NULL")
def _(spark: SparkSession, sf: str) -> DataFrame:
    name, folder = _sink(spark, "index_ddl")
    ensure_table(spark, name, INDEX_DDL, location=folder)
    rows = standin(spark, sf, "ddl_text").select(F.col("ddl").alias("contents_1"))
    truncate_reload(rows, name)
    truncate_reload(rows.where(F.col("contents_1").isNotNull()), name)
    return spark.table(name)


_BEFORE_PCT = "CASE WHEN instr(ddl, 'PCT') > 1 THEN substr(ddl, 1, instr(ddl, 'PCT') - 1) END AS contents_1"


@_register("index_ddl_extract", f"SELECT {_BEFORE_PCT} FROM ddl_text WHERE owner = 'ECONOMY'")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return index_ddl_extract(standin(spark, sf, "ddl_text"), "ECONOMY")


@_register("index_ddl_reload", f"SELECT {_BEFORE_PCT} FROM ddl_text WHERE owner = 'SMALL'")
def _(spark: SparkSession, sf: str) -> DataFrame:
    name, folder = _sink(spark, "index_ddl")
    ensure_table(spark, name, INDEX_DDL, location=folder)
    rows = standin(spark, sf, "ddl_text")
    reload_index_ddl(rows, "ECONOMY", name)
    reload_index_ddl(rows, "SMALL", name)
    return spark.table(name)


# --- logins ---------------------------------------------------------------------------

_VALID = r"""coalesce(regexp_matches(sso, 'i[Pp]hone\s|i[Pp]od\s|i[Pp]ad\s|[Aa]ndroid\s|[Ww]indows mobile\s')
                      AND regexp_matches(sso, '^Bugs\s'), false)"""
_PARSED_SQL = rf"""
    SELECT msrl, sso_srl, login_ip, login_tp, widget_ref, sso, valid,
        nullif(CASE WHEN instr(body, '(') > 2 THEN substr(body, 1, instr(body, '(') - 2) END, '') AS m_app_ver,
        CASE kind WHEN 'android' THEN regexp_extract(rest, '[Aa]ndroid')
                  WHEN 'windows' THEN nullif(regexp_extract(rest, 'Windows mobile'), '')
                  WHEN 'apple' THEN 'iOS' END AS m_platform_nm,
        nullif(CASE WHEN kind = 'android' THEN substr(regexp_replace(parts[1], '[Aa]ndroid ', '', 'g'), 1, 20)
                    WHEN kind IS NOT NULL THEN rtrim(regexp_extract(rest, '[0-9.]+\)'), ')') END, '') AS m_platform_ver,
        nullif(CASE kind WHEN 'android' THEN substr(parts[2], 1, 50)
                         WHEN 'apple' THEN regexp_extract(rest, 'i[Pp]hone|i[Pp]od|i[Pp]ad') END, '') AS m_device_nm,
        nullif(CASE kind WHEN 'android' THEN substr(parts[3], 1, 50) WHEN 'apple' THEN 'Apple' END, '') AS m_comp_nm,
        nullif(CASE kind WHEN 'android' THEN substr(parts[4], 1, 50) END, '') AS m_device_no
    FROM (SELECT *, string_split(replace(rest, ')', ''), ',') AS parts,
              CASE WHEN regexp_matches(rest, '[Aa]ndroid') THEN 'android'
                   WHEN regexp_matches(rest, '[Ww]indows mobile') THEN 'windows'
                   WHEN regexp_matches(rest, 'i[Pp]hone|i[Pp]od|i[Pp]ad') THEN 'apple' END AS kind
          FROM (SELECT *, CASE WHEN starts_with(sso, 'Bugs ') THEN substr(body, instr(body, '(') + 1) END AS rest
                FROM (SELECT *, CASE WHEN valid THEN replace(CASE WHEN starts_with(sso, 'Bugs ') THEN substr(sso, 6)
                                                                  ELSE sso END, ', ', ',') END AS body
                      FROM (SELECT *, {_VALID} AND coalesce(login_tp = 'M', false) AS valid FROM login_event) a) b) c) d
"""
_LOG_SQL = f"""
    SELECT msrl, sso_srl, login_ip AS login_ip1, login_tp, strftime({NOW}, '%Y%m%d%H%M%S') AS login_dt, widget_ref,
           m_app_ver, m_platform_nm, m_platform_ver, m_device_nm, m_comp_nm, m_device_no,
           CASE WHEN login_tp = 'M' AND NOT valid THEN sso END AS m_exception
    FROM ({_PARSED_SQL}) p"""


@_register("valid_client", f"SELECT msrl, {_VALID} AS valid, coalesce(login_tp = 'M', false) AS mobile FROM login_event")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return standin(spark, sf, "login_event").select(
        "msrl", valid_client("sso").alias("valid"), is_mobile("login_tp").alias("mobile")
    )


@_register(
    "parse_client",
    f"""SELECT msrl, m_app_ver, m_platform_nm, m_platform_ver, m_device_nm, m_comp_nm, m_device_no
        FROM ({_PARSED_SQL}) p""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return parse_client(standin(spark, sf, "login_event"), "sso", "login_tp").drop(
        "sso_srl", "login_ip", "login_tp", "widget_ref", "sso"
    )


@_register("ingest_logins", _LOG_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_logins(standin(spark, sf, "login_event"), AS_OF)


@_register("ingest_logins_stream", _LOG_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    folder = _new_folder(spark)
    standin(spark, sf, "login_event").repartition(4).write.parquet(f"{folder}/events")
    events = read_login_stream(spark, f"{folder}/events", files_per_trigger=2)
    ingest_logins_stream(events, f"{folder}/log", f"{folder}/checkpoint", AS_OF).awaitTermination()
    return spark.read.schema(LOGIN_LOG).parquet(f"{folder}/log")


@_register("ingest_logins_replayed", _LOG_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The stream into a table, started anew without its checkpoint: every batch comes again."""
    name, folder = _sink(spark, "login_log")
    ensure_batch_table(spark, name, LOGIN_LOG, f"{folder}/log")
    standin(spark, sf, "login_event").repartition(4).write.parquet(f"{folder}/events")
    for attempt in range(2):
        events = read_login_stream(spark, f"{folder}/events", files_per_trigger=2)
        ingest_logins_into(events, name, f"{folder}/checkpoint{attempt}", "logins", AS_OF).awaitTermination()
    return spark.table(name).select(*LOGIN_LOG.names)
