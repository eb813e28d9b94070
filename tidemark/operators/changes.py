"""Change capture: which rows and which ids changed after a cut.

The date filters sit directly on the scans, so they reach the file reader, and
only ids travel through shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import changed
from tidemark.operators.joins import Stage, has_parent

CREATED_OR_UPDATED = ("crt_dt", "upd_dt")


def changed_since(
    df: DataFrame, cut: datetime, cols: Sequence[str] = CREATED_OR_UPDATED
) -> DataFrame:
    """Rows with a date strictly after the cut."""
    return df.where(changed(cut, *cols))


def touched_ids(
    key: str,
    cut: datetime,
    own: Sequence[DataFrame],
    child: DataFrame | None = None,
    child_cols: Sequence[str] = CREATED_OR_UPDATED,
) -> DataFrame:
    """One row per id with a changed row, ``by_child`` telling if a child row was one.

    The flag is folded with a map-side aggregate, so an id with very many
    changed child rows costs one row per task in the shuffle.
    """
    parts = [
        changed_since(df, cut).select(key, F.lit(False).alias("by_child")) for df in own
    ]
    if child is not None:
        parts.append(changed_since(child, cut, child_cols).select(key, F.lit(True).alias("by_child")))
    return (
        reduce(DataFrame.unionAll, parts)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("by_child").alias("by_child"))
    )


def changed_ids(
    region: DataFrame,
    assoc: DataFrame,
    base: DataFrame | None,
    key: str,
    cut: datetime,
    stage: Stage | None = None,
    recent: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Ids that have a region row and an association row, any of them changed.

    A changed base row counts too when ``base`` is given. The candidate ids are
    as few as the change is small; written down first (``stage``), their exact
    size lets the two key scans run without shuffling the big tables. ``recent``
    are the parts of ``region`` and ``assoc`` that hold their changed rows; ``base``
    is only looked through for changes, so it may be such a part itself.
    """
    changed_region, changed_assoc = recent or (region, assoc)
    own = [changed_region] if base is None else [changed_region, base]
    candidates = touched_ids(key, cut, own, changed_assoc, ("upd_dt",)).select(key)
    if stage is not None:
        candidates = stage(candidates, f"candidates_{key}")
    in_region = has_parent(region.select(key), candidates, [key])
    in_assoc = has_parent(assoc.select(key), candidates, [key])
    if stage is not None:
        # before the same key is made distinct, so that Spark may split a hot id here
        in_assoc = stage(in_assoc, f"linked_{key}")
    return in_region.distinct().join(in_assoc.distinct(), key)


def changed_pairs(
    base: DataFrame,
    region: DataFrame,
    ids: DataFrame,
    key: str,
    cut: datetime,
) -> DataFrame:
    """Base rows joined with their region row, where either or a child changed.

    ``ids`` comes from :func:`touched_ids`. Dates and row code of the region row
    are named ``w_crt_dt``, ``w_upd_dt`` and ``w_db_sts``.
    """
    return base_with_region(base, region, ids, key).where(
        changed(cut, "crt_dt", "upd_dt", "w_crt_dt", "w_upd_dt") | F.col("by_child")
    )


def base_with_region(base: DataFrame, region: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Base rows of the given ids with the dates and row code of their region row."""
    renamed = region.select(
        key, *[F.col(c).alias(f"w_{c}") for c in ("crt_dt", "upd_dt", "db_sts")]
    )
    return base.join(ids, key).join(has_parent(renamed, ids, [key]), key)
