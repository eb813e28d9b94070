"""Reading the source tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.schemas import LYRICS_SOURCES, SOURCES
from tidemark.sources.file_dates import FileDates, date_columns, read_files


class Replicas(dict[str, DataFrame]):
    """Tables by name; of those with dates also the part that a cut leaves to look at."""

    def __init__(self, tables: Mapping[str, DataFrame], paths: Mapping[str, str], dates: FileDates):
        super().__init__(tables)
        self._paths, self._dates = paths, dates
        self._since: dict[tuple[str, datetime], DataFrame] = {}

    def since(self, name: str, cut: datetime) -> DataFrame:
        """The rows of all files that hold a row dated after the cut; others among them."""
        if (name, cut) not in self._since:
            self._since[name, cut] = self._read_since(name, cut)
        return self._since[name, cut]

    def _read_since(self, name: str, cut: datetime) -> DataFrame:
        cols = date_columns(self[name].schema)
        paths = self._dates.paths_since(name, cut, cols) if cols else None
        if paths is None:
            return self[name]
        if not paths:
            return self[name].limit(0)
        return read_files(self[name].sparkSession, self._paths[name], self[name].schema, paths)


def load_sources(
    spark: SparkSession,
    root: str,
    lyrics_root: str | None = None,
    names: Iterable[str] | None = None,
    dates_root: str | None = None,
) -> dict[str, DataFrame]:
    """Parquet replicas by name, with declared schemas.

    The lyrics tables live in another database; their replica may have its own root.
    With ``dates_root`` the largest dates of each file are kept there, and a run looks
    for changes only in files that can hold some. A list is brought up to date before
    its replica is opened, so whatever it names is there to be read; files that arrive
    in between are left to the next run, whose cut goes back to the day of this one.
    """
    lyrics_root = lyrics_root or root
    paths = {n: f"{lyrics_root if n in LYRICS_SOURCES else root}/{n}" for n in (names or SOURCES)}
    if dates_root is None:
        return _opened(spark, paths)
    dates = FileDates(spark, dates_root)
    for name, path in paths.items():
        if date_columns(SOURCES[name]):
            dates.refresh(name, path, SOURCES[name])
    return Replicas(_opened(spark, paths), paths, dates)


def _opened(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(SOURCES[name]).parquet(path) for name, path in paths.items()}


def jdbc_options(
    url: str,
    table: str,
    schema: StructType,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel read, split by ranges of a numeric key."""
    return {
        "url": url,
        "dbtable": table,
        "customSchema": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields),
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
    }


def load_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Read a table straight from its database; filters and columns are pushed to it."""
    return spark.read.format("jdbc").options(**options).load()
