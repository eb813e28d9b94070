"""Changes applied to a target, as a new version of it.

Each function takes the target and returns its next version as a lazy frame;
``sources.snapshots`` writes it. Target rows stream through without a shuffle
whenever Spark can broadcast the other side, which it decides on the exact file
size when that side was staged (``sources.staging``), as it is here. Beyond its
threshold the same plans run as sort-merge joins that Spark can split at a hot key;
target rows without a key pass by them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import as_column
from tidemark.operators.joins import Stage, distinct_keys, raise_if, staged, with_keys, without_keys
from tidemark.sources.staging import Staging

_SRC = "src"
_COUNT = "__n"
_HIT = "__hit"


def _next_version(target: DataFrame, values: Mapping[str, Column]) -> list[Column]:
    """The target's columns in order and type, some with a new value."""
    return [
        values[f.name].cast(f.dataType).alias(f.name) if f.name in values else F.col(f.name)
        for f in target.schema.fields
    ]


def _checked(target: DataFrame, values: Mapping[str, Column | str]) -> dict[str, Column]:
    unknown = set(values) - set(target.columns)
    if unknown:
        raise ValueError(f"not a target column: {sorted(unknown)}")
    return {name: as_column(value) for name, value in values.items()}


def _one_row_per_key(rows: DataFrame, keys: list[str], label: str, stage: Stage | None) -> DataFrame:
    """Keys, the only row of a key as a struct, and how many rows it has; staged.

    Rows are counted by hash and joined as they are, so none is sorted to pick one. A
    key with several rows, which no caller lets through, has no struct. Rows that are
    staged already, each with a key of its own, are not written again.
    """
    stage = stage or Staging(rows.sparkSession)
    row = F.struct(*[F.col(c) for c in rows.columns]).alias(_SRC)
    keyed = with_keys(rows, keys)
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT))
    several = staged(counts.where(F.col(_COUNT) > 1), f"several_{label}", stage)
    if isinstance(stage, Staging) and stage.wrote(rows) and stage.is_empty(several):
        return keyed.select(*keys, row, F.lit(1).cast("long").alias(_COUNT))
    once = keyed.join(several.select(*keys), keys, "left_anti").select(*keys, row, F.lit(1).cast("long").alias(_COUNT))
    none = F.lit(None).cast(once.schema[_SRC].dataType).alias(_SRC)
    return staged(once.unionByName(several.select(*keys, none, _COUNT)), f"rows_{label}", stage)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_match: Mapping[str, Column | str],
    on_insert: Mapping[str, Column | str],
    stage: Stage | None = None,
) -> DataFrame:
    """Update the target rows that match a source row, insert the other source rows.

    Values refer to source columns as ``src.<name>`` and to the target's old
    values by name. Insert values default to the keys; columns that are not
    named become NULL. A NULL key matches nothing, so such rows are inserted.
    Two source rows for one target row are an error.
    """
    keys = list(keys)
    on_match = _checked(target, on_match)
    on_insert = {k: F.col(f"{_SRC}.{k}") for k in keys} | _checked(target, on_insert)
    source_row = F.struct(*[F.col(c) for c in source.columns])

    per_key = _one_row_per_key(source, keys, "_".join(keys), stage)
    updated = (
        with_keys(target, keys)
        .join(per_key, keys, "left")
        .where(raise_if(F.col(_COUNT) > 1, f"upsert on {keys}: several source rows match one row"))
        .select(
            *_next_version(
                target,
                {
                    name: F.when(F.col(_COUNT).isNotNull(), value).otherwise(F.col(name))
                    for name, value in on_match.items()
                },
            )
        )
    )

    # The keys already present, found by streaming the target's key columns past
    # the source keys: never larger than the source.
    present = target.select(*keys).join(per_key.select(*keys), keys, "left_semi")
    fresh = with_keys(source, keys).join(present, keys, "left_anti")
    nothing = {f.name: F.lit(None) for f in target.schema.fields}
    inserted = (
        fresh.select(*source.columns)
        # rows with a NULL key match nothing; kept out of the join, they cannot fill one task
        .unionAll(without_keys(source, keys))
        .select(source_row.alias(_SRC))
        .select(
            *[
                value.cast(target.schema[name].dataType).alias(name)
                for name, value in (nothing | on_insert).items()
            ]
        )
    )
    return updated.unionAll(without_keys(target, keys)).unionAll(inserted)


def update_if(
    target: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    set: Mapping[str, Column],
    guard: Column | None = None,
    exists: bool = True,
    stage: Stage | None = None,
) -> DataFrame:
    """Set columns on the target rows that have (or lack) a match in ``other``."""
    on = list(on)
    values = _checked(target, set)
    hits = staged(distinct_keys(other, on), "_".join(["hits", *on]), stage)

    def updated(rows: DataFrame, applies: Column) -> DataFrame:
        if guard is not None:
            applies = applies & guard
        changed = {name: F.when(applies, value).otherwise(F.col(name)) for name, value in values.items()}
        return rows.select(*_next_version(target, changed))

    flagged = with_keys(target, on).join(hits.withColumn(_HIT, F.lit(True)), on, "left")
    found = updated(flagged, F.col(_HIT).isNotNull() if exists else F.col(_HIT).isNull())
    return found.unionAll(updated(without_keys(target, on), F.lit(not exists)))


def update_from_lookup(
    target: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    set: Mapping[str, Column | str],
    guard: Column | None = None,
    bad: Column | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Set columns from the single matching lookup row; other rows stay.

    Values refer to lookup columns as ``src.<name>``. Two lookup rows for one
    updated row are an error. A staged lookup that is unique per key already says with
    ``bad`` which of its rows must not be used, and is then joined as it is.
    """
    keys = list(on)
    values = _checked(target, set)
    if bad is None:
        per_key = _one_row_per_key(lookup, keys, "_".join(keys), stage)
        bad = F.col(_COUNT) > 1
    else:
        row = F.struct(*[F.col(c) for c in lookup.columns])
        per_key = with_keys(lookup, keys).select(*keys, row.alias(_SRC), F.lit(1).alias(_COUNT))
    applies = F.col(_COUNT).isNotNull()
    if guard is not None:
        applies = applies & guard
    changed = {name: F.when(applies, value).otherwise(F.col(name)) for name, value in values.items()}
    return (
        with_keys(target, keys)
        .join(per_key, keys, "left")
        .where(raise_if(applies & bad, f"update on {keys}: several rows match one row"))
        .select(*_next_version(target, changed))
        .unionAll(without_keys(target, keys))
    )
