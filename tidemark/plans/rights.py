"""Streaming, download and rental rights of tracks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.status import yes_no
from tidemark.operators.apply import update_from_lookup
from tidemark.operators.changes import changed_since
from tidemark.plans.context import Run, Tables

KEY = "track_id"
# Which columns of the region row each kind of right is written to.
RIGHT_COLUMNS = {
    "str": ("str_rights_yn", "mv_str_rights_yn"),
    "dnl": ("dnl_rights_yn",),
    "rent": ("rent_rights_yn",),
}


def rights_per_track(rights: DataFrame, services: Mapping[str, int]) -> DataFrame:
    """One row per track: ``<name>_yn`` and the row count ``<name>_n`` of every service.

    One scan and one map-side aggregate serve all services.
    """
    of = {name: F.col("service_id") == service for name, service in services.items()}
    return (
        rights.where(F.col("service_id").isin(*services.values()) & F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(
            *[F.min(F.when(is_it, F.col("right_yn"))).alias(f"{n}_yn") for n, is_it in of.items()],
            *[F.count(F.when(is_it, F.lit(1))).alias(f"{n}_n") for n, is_it in of.items()],
        )
    )


def several_rights(services: Mapping[str, int], prefix: str = "") -> Column:
    """A track has more than one right row for one of the services."""
    return reduce(Column.__or__, [F.col(f"{prefix}{name}_n") > 1 for name in services])


def _sync(src: Tables, tgt: Tables, run: Run, services: Mapping[str, int]) -> DataFrame:
    lookup = run.stage(
        rights_per_track(changed_since(run.recent(src, "ttmp_trackright"), run.cut), services),
        "_".join(["rights", *services]),
    )
    if run.stage.is_empty(lookup):
        return tgt["track_local"]
    values: dict[str, Column] = {"upd_dt": run.now}
    for name in services:
        for column in RIGHT_COLUMNS[name]:
            values[column] = F.when(
                F.col(f"src.{name}_n") > 0, yes_no(f"src.{name}_yn")
            ).otherwise(F.col(column))
    touched = lookup.select(KEY, run.code.alias("local_cd"))
    return update_from_lookup(
        run.narrow(tgt["track_local"], "track_local", touched),
        lookup,
        [KEY],
        values,
        guard=F.col("local_cd") == run.code,
        bad=several_rights(services, "src."),
    )


def sync_stream_rights(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    return _sync(src, tgt, run, {"str": run.region.streaming})


def sync_download_rights(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    return _sync(src, tgt, run, {"dnl": run.region.download})


def sync_rental_rights(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    if run.region.rental is None:
        return tgt["track_local"]
    return _sync(src, tgt, run, {"rent": run.region.rental})


def sync_track_rights(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    """All kinds of rights the region has, in one pass over the target."""
    services = {"str": run.region.streaming, "dnl": run.region.download}
    if run.region.rental is not None:
        services["rent"] = run.region.rental
    return _sync(src, tgt, run, services)
