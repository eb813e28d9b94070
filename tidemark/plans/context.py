"""What every step of one run shares."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Region
from tidemark.functions.dates import at, cutoff
from tidemark.operators.apply import upsert
from tidemark.sources.catalog import Replicas
from tidemark.sources.staging import Staging

Tables = Mapping[str, DataFrame]


def whole_table(target: DataFrame, name: str, rows: DataFrame) -> DataFrame:
    return target


@dataclass(frozen=True)
class Run:
    """Region, run time, change cut and the place for intermediate tables.

    ``narrow`` may cut a target down to the part that given rows can change; by
    default every step returns the whole next version of its target.
    """

    region: Region
    as_of: datetime
    cut: datetime
    stage: Staging
    narrow: Callable[[DataFrame, str, DataFrame], DataFrame] = whole_table

    @classmethod
    def start(
        cls,
        spark: SparkSession,
        region: Region,
        as_of: datetime,
        offset_days: float | None = None,
        narrow: Callable[[DataFrame, str, DataFrame], DataFrame] = whole_table,
        since: datetime | None = None,
    ) -> Run:
        """``since`` is the last run before this one: its day is the cut if it is the earlier one."""
        cut = cutoff(as_of, offset_days)
        if since is not None:
            cut = min(cut, cutoff(since, 0))
        return cls(region, as_of, cut, Staging(spark), narrow)

    @property
    def now(self) -> Column:
        return at(self.as_of)

    @property
    def code(self) -> Column:
        return F.lit(self.region.code)

    def of_region(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("nation_cd") == self.region.code)

    def recent(self, src: Tables, name: str) -> DataFrame:
        """Where to look for rows changed since the cut: the table, or its files that can hold some."""
        return src.since(name, self.cut) if isinstance(src, Replicas) else src[name]

    def upsert(
        self,
        target: DataFrame,
        source: DataFrame,
        name: str,
        keys: Sequence[str],
        on_match: Mapping[str, Column | str],
        on_insert: Mapping[str, Column | str],
    ) -> DataFrame:
        """Stage the changed rows, then upsert them; the target itself if there are none."""
        staged = self.stage(source, name)
        if self.stage.is_empty(staged):
            return target
        return upsert(self.narrow(target, name, staged), staged, keys, on_match, on_insert, self.stage)


def same_named(*columns: str) -> dict[str, str]:
    """SET or INSERT list that copies source columns of the same name."""
    return {c: f"src.{c}" for c in columns}
