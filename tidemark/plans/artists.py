"""Artists, their region rows and their styles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.status import status_of
from tidemark.operators.changes import changed_pairs, changed_since, touched_ids
from tidemark.operators.joins import has_parent, known_in, lookup_one
from tidemark.plans.context import Run, Tables, same_named
from tidemark.plans.styles import changed_styles
from tidemark.schemas import TARGETS

KEY = "artist_id"
SITE_KIND = "ted_artist"  # fixed value: marks the web sites that belong to artists


def sync_artist(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    base, region = src["ted_artist"], run.of_region(src["ted_artist_w"])
    recent = run.of_region(run.recent(src, "ted_artist_w"))
    if run.region.regional:
        ids = run.stage(touched_ids(KEY, run.cut, [run.recent(src, "ted_artist"), recent]), "artist_ids")
        rows = changed_pairs(base, region, ids, KEY, run.cut)
        status = status_of("w_db_sts", "db_sts")
    else:
        ids = run.stage(touched_ids(KEY, run.cut, [recent]), "artist_ids")
        rows = has_parent(base, ids, [KEY])
        status = status_of("db_sts")

    sites = src["tfm_website"].where(F.col("rel_entity_cd") == SITE_KIND)
    sites = has_parent(sites.select(F.col("rel_id").alias(KEY), "site_url"), ids, [KEY])
    rows = lookup_one(rows, sites, [KEY], "site_url", "homepage_url", stage=run.stage)

    copied = [c for c in TARGETS["artist"].names if c not in (KEY, "upd_dt", "status")]
    return run.upsert(
        tgt["artist"],
        rows.select(KEY, *copied, status.alias("status")),
        "artist",
        [KEY],
        on_match=same_named(*copied, "status") | {"upd_dt": run.now},
        on_insert=same_named(*copied, "status"),
    )


def sync_artist_local(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    rows = changed_since(run.of_region(run.recent(src, "ted_artist_w")), run.cut)
    if run.region.regional:
        rows = known_in(run.stage(rows, "artist_local_rows"), tgt["artist"], [KEY], run.stage)
    names = {"disp_nm_local": "src.artist_nm", "search_nm_local": "src.artist_nm"}
    return run.upsert(
        tgt["artist_local"],
        rows.select(
            KEY, run.code.alias("local_cd"), "artist_nm", "crt_dt", status_of("db_sts").alias("status")
        ),
        "artist_local",
        [KEY, "local_cd"],
        on_match=names | same_named("status") | {"upd_dt": run.now},
        on_insert=names | same_named("crt_dt", "status"),
    )


def sync_artist_style(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    rows = changed_styles(src, "tbm_artiststyle", KEY, run.of_region(src["ted_artist_w"]), run)
    if run.region.regional:
        rows = known_in(rows, tgt["artist"], [KEY], run.stage)
        rows = known_in(rows, tgt["style"], ["style_id"], run.stage)
    return run.upsert(
        tgt["artist_style"],
        rows.select(KEY, "style_id", "listorder"),
        "artist_style",
        [KEY, "style_id"],
        on_match=same_named("listorder"),
        on_insert=same_named("listorder") | {"crt_dt": run.now},
    )
