"""Intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts lineage, survives lost executors and, being a file, has an
exact size. Spark compares that size with ``spark.sql.autoBroadcastJoinThreshold``
when it plans the next join: a small change set is broadcast past the big tables
without shuffling them, a large one is sort-merge joined. The library therefore
hints no broadcast anywhere.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings
from itertools import count

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import Files

_CONF = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}  # folders of local sessions that name none, by application


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session, or one of our own on a local master only."""
    named = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF, None)
    named = named or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if named:
        if not local and named.startswith(("/", "file:")):
            warnings.warn(f"{_CONF} is a plain path: every executor must mount {named}", stacklevel=2)
        return named
    if not local:
        raise ValueError(f"set {_CONF} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _OWN[app]


class Staging:
    """Writes frames under one folder per run and hands back the written tables."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._root = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
        self._numbers = count(1)
        self._rows: dict[int, tuple[DataFrame, int]] = {}

    def __call__(self, df: DataFrame, label: str, reduced: bool = False) -> DataFrame:
        """The written table. ``reduced`` frames come from a shuffle or another staged
        table and have few files anyway."""
        path = f"{self._root}/{next(self._numbers):03d}_{label}"
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        # rebalance: a change picked from thousands of scan tasks becomes a few even files
        rows = df if reduced else df.hint("rebalance")
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        self._rows[id(out)] = out, seen.get["n"]
        return out

    def wrote(self, df: DataFrame) -> bool:
        return id(df) in self._rows

    def is_empty(self, staged: DataFrame) -> bool:
        """Known from the write; no job."""
        return self._rows[id(staged)][1] == 0

    def remove(self) -> None:
        """Delete the folder, when nothing reads the staged tables any more."""
        self._rows.clear()
        Files(self._spark).remove(self._root)
