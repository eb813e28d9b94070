"""Which files of a replica can hold changes after a cut.

The replicas are folders of parquet files. Their largest dates are kept per file in a
small table of its own folder, brought up to date before the replicas are read: only
the date columns of files that are new, or were replaced under their name, are read for
it. A cut then names the files worth opening. The table is derived from the replicas
alone, so one that is lost is simply written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from tidemark.functions.dates import changed
from tidemark.sources.files import Files

_SAME = ["file", "bytes", "modified"]  # a file that agrees in these has not changed
_KEPT = 3  # lists a reader that began earlier may still read
_PER_TASK = "16g"  # of files whose names a task lists; none is opened


def date_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, TimestampNTZType)]


class FileDates:
    """Lists of files and their largest dates, one table per replica under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._reader = spark  # dates are read in tasks of the usual size
        # a session of its own: its file scans open no contents, so they take many files a task
        self._spark = spark.newSession()
        self._spark.conf.set("spark.sql.files.maxPartitionBytes", _PER_TASK)
        self._spark.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
        self._files = Files(spark)
        self._root = root

    def refresh(self, name: str, path: str, schema: StructType) -> int:
        """Bring a replica's list up to date; returns how many files were read for it.

        A file without rows, or with NULL dates only, is listed with NULLs and never read
        again. Files that are gone leave the list.
        """
        lists = self._lists(name)
        listed = self._listed(path)
        known = self._spark.read.parquet(lists[-1]) if lists else None
        if known is not None and {*_SAME, *date_columns(schema)} != set(known.columns):
            known = None  # written for other date columns
        fresh = listed if known is None else listed.join(known.select(_SAME), _SAME, "left_anti")
        paths = [r.file for r in fresh.select("file").collect()]
        if known is not None and not paths and listed.count() == known.count():
            return 0
        dates = self._dates(path, schema, paths)
        # joined on the listing taken now: dates and the state of a file belong together
        entries = listed.join(dates, "file")
        if known is not None:
            entries = entries.unionByName(known.join(listed, _SAME, "left_semi"))
        number = 1 + (int(lists[-1].rpartition("/")[2].partition("-")[0]) if lists else 0)
        entries.write.parquet(f"{self._root}/{name}/{number:010d}-{uuid.uuid4().hex}")
        oldest = lists[1 - _KEPT :][0].rpartition("/")[2] if lists else ""
        for one in self._files.names(f"{self._root}/{name}"):
            if one < oldest:  # also what a run that died left behind
                self._files.remove(f"{self._root}/{name}/{one}")
        return len(paths)

    def paths_since(self, name: str, cut: datetime, cols: Sequence[str]) -> list[str] | None:
        """Files with a row dated after the cut in one of the columns; None if all have one.

        As many names as Spark's own listing of those files holds on the driver.
        """
        listed = self._spark.read.parquet(self._lists(name)[-1])
        recent = [unquote(r.file) for r in listed.where(changed(cut, *cols)).select("file").collect()]
        return None if len(recent) == listed.count() else sorted(recent)

    def _lists(self, name: str) -> list[str]:
        """Complete lists, the newest last."""
        folder = f"{self._root}/{name}"
        return [f"{folder}/{one}" for one in self._files.names(folder) if "_SUCCESS" in self._files.names(f"{folder}/{one}")]

    def _listed(self, path: str) -> DataFrame:
        """The replica's files as they are now; no contents are read."""
        meta = {"file": "file_path", "bytes": "file_size", "modified": "file_modification_time"}
        return self._spark.read.format("binaryFile").load(path).select(
            *[F.col(f"_metadata.{field}").alias(name) for name, field in meta.items()]
        )

    def _dates(self, path: str, schema: StructType, paths: Sequence[str]) -> DataFrame:
        """The largest dates of the given files, with a row for each file."""
        cols = date_columns(schema)
        names = self._spark.createDataFrame([(p,) for p in paths], "file string")
        if not paths:
            return reduce(lambda df, c: df.withColumn(c, F.lit(None).cast("timestamp_ntz")), cols, names)
        rows = read_files(self._reader, path, schema, [unquote(p) for p in paths])
        largest: list[Column] = [F.max(c).alias(c) for c in cols]
        found = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*largest)
        return names.join(found, "file", "left")


def read_files(spark: SparkSession, path: str, schema: StructType, paths: Sequence[str]) -> DataFrame:
    """Some files of a replica, as a read of its whole folder would give their rows."""
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)
