"""Separated text to rows or columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import blank_to_null, capped, split_fields


def split_rows(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """One row per field, numbered from 1 in ``field_no``; empty fields are NULL."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.posexplode(split_fields(col, sep)).alias("pos", col)).select(
        *others, (F.col("pos") + 1).alias("field_no"), blank_to_null(col).alias(col)
    )


def fields_to_columns(
    df: DataFrame, col: str, spec: Mapping[str, tuple[int, int]], sep: str = ","
) -> DataFrame:
    """Named columns from ``{name: (field number, length cap)}``; missing fields are NULL."""
    fields = split_fields(col, sep)
    return df.withColumns(
        {name: capped(F.get(fields, number - 1), cap) for name, (number, cap) in spec.items()}
    )
