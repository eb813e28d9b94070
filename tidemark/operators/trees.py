"""Two-level tree kept in one table; a root is its own parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tree_roots(df: DataFrame, key: str, parent: str) -> DataFrame:
    return df.where(F.col(key) == F.col(parent))


def tree_children(df: DataFrame, key: str, parent: str) -> DataFrame:
    return df.where(F.col(key) != F.col(parent))
