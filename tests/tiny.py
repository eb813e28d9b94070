"""Tiny random catalogues: few ids, so that rows meet, miss and repeat."""

from __future__ import annotations

import random
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.types import LongType, TimestampNTZType

from tidemark.schemas import SOURCES, TARGETS

AS_OF = datetime(2024, 1, 10, 9, 0)
CUT = datetime(2024, 1, 9)
DATES = [None, datetime(2023, 5, 1), CUT, datetime(2024, 1, 9, 0, 0, 1), datetime(2024, 1, 10, 8)]
CODES = ["VNM", "JPN", "KOR"]
IDS = range(1, 7)

KEYS = {
    "ted_artist": ["artist_id"], "ted_artist_w": ["artist_id", "nation_cd"], "tfm_website": ["rel_entity_cd", "rel_id"],
    "tbm_artiststyle": ["artist_id", "style_id"], "ted_album": ["album_id"], "ted_album_w": ["album_id", "nation_cd"],
    "ted_albumartist": [], "tbm_albumstyle": ["album_id", "style_id"], "ted_track": ["track_id"],
    "ted_track_w": ["track_id", "nation_cd"], "ted_trackartist": [], "ttmp_trackright": ["track_id", "service_id"],
    "ted_mv": ["mv_id"], "ted_mv_w": ["mv_id", "nation_cd"], "ted_mvtrack": ["mvtrack_id"], "tmu_genre": ["genre_cd"],
    "time_lyrics": [], "normal_lyrics": [],
    "artist": ["artist_id"], "artist_local": ["artist_id", "local_cd"], "artist_style": ["artist_id", "style_id"],
    "album": ["album_id"], "album_local": ["album_id", "local_cd"], "album_style": ["album_id", "style_id"],
    "track": ["track_id"], "track_local": ["track_id", "local_cd"], "track_style": ["track_id", "style_id"],
    "mv": ["mv_id"], "mv_local": ["mv_id", "local_cd"], "genre": ["genre_id"], "style": ["style_id"],
}


def _value(rng: random.Random, table: str, field, key: bool):
    name = field.name
    if isinstance(field.dataType, TimestampNTZType):
        return rng.choice(DATES)
    if name in ("nation_cd", "local_cd") and (key or table.endswith("lyrics")):
        return rng.choice(CODES)
    if name == "service_id":
        return rng.choice([714, 715, 716, 717, 718, 1])
    if name == "mvtrack_id":
        return rng.randrange(1, 1000)
    if isinstance(field.dataType, LongType):
        return rng.choice(IDS)
    if name == "rel_entity_cd":
        return rng.choice(["ted_artist", "ted_album"])
    if name == "db_sts":
        return rng.choice(["A", "A", "A", "D", None])
    if name == "status":
        return rng.choice(["OK", "BLIND", None])
    if name == "lyrics_tp":
        return rng.choice(["T", "N", None])
    if name.endswith("_yn") or name == "rp_cd":
        return rng.choice(["Y", "Y", "N", None])
    return rng.choice(["a", "b", "c", None])


def table(rng: random.Random, name: str, size: int) -> list[dict]:
    schema, keys = (SOURCES | TARGETS)[name], KEYS[name]
    rows, seen = [], set()
    for _ in range(size):
        row = {f.name: _value(rng, name, f, f.name in keys) for f in schema.fields}
        key = tuple(row[k] for k in keys)
        if not keys or key not in seen:
            seen.add(key)
            rows.append(row)
    return rows


def catalogue(seed: int) -> tuple[dict, dict]:
    rng = random.Random(seed)
    src = {n: table(rng, n, rng.randrange(4, 14)) for n in SOURCES}
    tgt = {n: table(rng, n, rng.randrange(0, 8)) for n in TARGETS}
    return src, tgt


def frame(spark: SparkSession, name: str, rows: list[dict]):
    schema = (SOURCES | TARGETS)[name]
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)


def frames(spark: SparkSession, tables: dict) -> dict:
    return {n: frame(spark, n, rows) for n, rows in tables.items()}


def as_rows(tables: dict) -> dict:
    """Model tables as sorted tuples, to compare with collected frames."""
    return {
        n: sorted((tuple(r[c] for c in TARGETS[n].names) for r in rows), key=repr) for n, rows in tables.items()
    }
