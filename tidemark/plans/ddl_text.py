"""Shortened DDL text of one owner's indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import text_before
from tidemark.schemas import INDEX_DDL
from tidemark.sources.sinks import truncate_reload

MARKER = "PCT"  # fixed value: storage settings start here


def index_ddl_extract(df: DataFrame, owner: str, marker: str = MARKER) -> DataFrame:
    """One row per index of the owner: its text before the marker, NULL without one."""
    return df.where(F.col("owner") == owner).select(text_before("ddl", marker).alias("contents_1"))


def reload_index_ddl(df: DataFrame, owner: str, sink: str, marker: str = MARKER) -> None:
    """Refill the sink table, creating it if it is absent."""
    truncate_reload(index_ddl_extract(df, owner, marker), sink, INDEX_DDL)
