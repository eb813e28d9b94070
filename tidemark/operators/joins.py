"""Join shapes of the sync. No side is hinted: see ``sources.staging``.

A side that is reduced to one row per key is staged before it is joined. Its size is
then known, and beyond the broadcast threshold both sides of the join lie directly on
a shuffle, which is what Spark needs to split a hot key. Rows whose key is NULL match
nothing; they pass by the join, so that no task gathers them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import as_column
from tidemark.sources.staging import Staging

Stage = Callable[[DataFrame, str], DataFrame]

_FLAG = "__hit"
_COUNT = "__n"


def raise_if(bad: Column, message: str) -> Column:
    """A filter condition that keeps every row, or fails the query.

    As a filter, unlike as a projected column, it survives column pruning.
    """
    failing = F.raise_error(F.lit(message)).cast("boolean")
    return F.when(bad, failing).otherwise(F.lit(True))


def with_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a NULL in the key; only these can match anything."""
    return df.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in on]))


def distinct_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct non-NULL keys, reduced on the map side before any shuffle."""
    return with_keys(df.select(*on), on).distinct()


def without_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows that :func:`with_keys` leaves out."""
    return df.where(reduce(Column.__or__, [F.col(k).isNull() for k in on]))


def staged(df: DataFrame, label: str, stage: Stage | None) -> DataFrame:
    """A reduced side, written by the run's staging or one of its own."""
    stage = stage or Staging(df.sparkSession)
    return stage(df, label, reduced=True) if isinstance(stage, Staging) else stage(df, label)


def has_parent(
    df: DataFrame, parent: DataFrame, on: Sequence[str], unique: bool = True, stage: Stage | None = None
) -> DataFrame:
    """Rows with at least one match in ``parent``.

    ``unique=False`` reduces the parent's keys first, for parents in which one
    key may own a large share of the rows.
    """
    if unique:
        return df.join(parent.select(*on), list(on), "left_semi")
    keys = staged(distinct_keys(parent, on), "_".join(["parents", *on]), stage)
    return with_keys(df, on).join(keys, list(on), "left_semi")


def known_in(rows: DataFrame, parent: DataFrame, on: Sequence[str], stage: Stage) -> DataFrame:
    """Rows of a staged frame with a match in a big ``parent``.

    The same rows as :func:`has_parent`, but the parent is first cut down to the
    keys that occur in ``rows``: its key columns stream past the broadcast keys
    instead of all being shuffled to meet a few rows. What is left of it is staged
    too, so Spark knows its size; if both sides are big, it can split hot keys.
    """
    present = parent.select(*on).join(distinct_keys(rows, on), list(on), "left_semi")
    return rows.join(stage(present, "_".join(["known", *on])), list(on), "left_semi")


def lacks(
    df: DataFrame, other: DataFrame, on: Sequence[str], unique: bool = False, stage: Stage | None = None
) -> DataFrame:
    """Rows without any match in ``other``, those without a key among them."""
    keys = other.select(*on) if unique else staged(distinct_keys(other, on), "_".join(["others", *on]), stage)
    return with_keys(df, on).join(keys, list(on), "left_anti").unionByName(without_keys(df, on))


def with_exists_flag(
    df: DataFrame, other: DataFrame, on: Sequence[str], flag: str, stage: Stage | None = None
) -> DataFrame:
    """Add a boolean that tells if ``other`` has a match; every row is kept."""
    keys = staged(distinct_keys(other, on), f"flag_{flag.strip('_')}", stage).withColumn(flag, F.lit(True))
    found = with_keys(df, on).join(keys, list(on), "left")
    found = found.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return found.unionByName(without_keys(df, on).withColumn(flag, F.lit(False)))


def lookup_one(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    value: str,
    alias: str,
    default: Column | str | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Add the value of the single match, or the default when there is none.

    Fails when a row of ``df`` has several matches. The matches are reduced to a
    count and one value per key before the join, so a duplicated key neither
    multiplies rows nor fills one task.
    """
    single = (
        with_keys(other, on)
        .groupBy(*on)
        .agg(F.min(value).alias(alias), F.count(F.lit(1)).alias(_COUNT))
    )
    single = staged(single, f"lookup_{alias}", stage)
    default = F.lit(default) if default is None or isinstance(default, str) else default
    found = with_keys(df, on).join(single, list(on), "left").where(
        raise_if(F.col(_COUNT) > 1, f"lookup of {alias}: more than one row for a key")
    )
    found = found.withColumn(alias, F.coalesce(F.col(alias), default)).drop(_COUNT)
    none = default.cast(single.schema[alias].dataType)
    return found.unionByName(without_keys(df, on).withColumn(alias, none))


def first_child(
    df: DataFrame,
    assoc: DataFrame,
    key: str,
    child: str,
    alive: Column,
    parent: DataFrame,
    stage: Stage | None = None,
) -> DataFrame:
    """Add one living child per row that exists in ``parent``: the smallest id.

    Any child would do; the smallest makes reruns agree and folds on the map
    side. With ``stage``, ``assoc`` holds the few links of changed rows, which
    are staged so that the parent need not be shuffled.
    """
    links = assoc.where(alive).select(key, child)
    if stage is None:
        living = has_parent(links, parent, [child])
    else:
        living = known_in(stage(links, f"links_{key}"), parent, [child], stage)
    chosen = with_keys(living, [key]).groupBy(key).agg(F.min(child).alias(child))
    chosen = staged(chosen, f"first_{child}", stage)
    none = F.lit(None).cast(chosen.schema[child].dataType)
    found = with_keys(df, [key]).join(chosen, key, "left")
    return found.unionByName(without_keys(df, [key]).withColumn(child, none))


def top1(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each group.

    The rank filter is applied per input partition before the shuffle, so a huge
    group sends one row per task.
    """
    window = Window.partitionBy(*by).orderBy(*[as_column(c) for c in order])
    return df.withColumn(_FLAG, F.row_number().over(window)).where(F.col(_FLAG) == 1).drop(_FLAG)
