"""Text expressions that treat the empty string as NULL.

The source data comes from a database without empty strings, so every
expression here that could yield ``''`` yields NULL instead.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def joined(*values: Column | str) -> Column:
    """Concatenate; a NULL part counts as empty."""
    return blank_to_null(F.concat_ws("", *[as_column(v) for v in values]))


def first_match(value: Column | str, pattern: str) -> Column:
    """First match of a regular expression, NULL if there is none."""
    return blank_to_null(F.regexp_substr(as_column(value), F.lit(pattern)))


def replace_pattern(value: Column | str, pattern: str, replacement: str = "") -> Column:
    return blank_to_null(F.regexp_replace(as_column(value), pattern, replacement))


def replace_text(value: Column | str, old: str, new: str = "") -> Column:
    return blank_to_null(F.replace(as_column(value), F.lit(old), F.lit(new)))


def piece(value: Column | str, start: Column | int, length: Column | int) -> Column:
    """Substring from a 1-based position; NULL when the length is not positive."""
    start = F.lit(start) if isinstance(start, int) else start
    length = F.lit(length) if isinstance(length, int) else length
    return blank_to_null(F.substring(as_column(value), start, length))


def capped(value: Column | str, length: int) -> Column:
    return piece(value, 1, length)


def position(value: Column | str, text: str) -> Column:
    """1-based position of the first occurrence, 0 if absent."""
    return F.instr(as_column(value), text)


def nth_position(value: Column | str, text: str, n: int) -> Column:
    """1-based position of the n-th occurrence, 0 if there are fewer."""
    column = as_column(value)
    head = F.substring_index(column, text, n)
    # substring_index returns the whole text when there are fewer than n
    return F.when(column.isNull(), F.lit(None).cast("int")).otherwise(
        F.when(F.length(head) < F.length(column), F.length(head) + 1).otherwise(F.lit(0))
    )


def text_before(value: Column | str, marker: str) -> Column:
    """Text before the first marker; NULL when the marker is absent or leads."""
    column = as_column(value)
    return F.when(position(column, marker) > 1, F.substring(column, F.lit(1), position(column, marker) - 1))


def split_fields(value: Column | str, separator: str = ",") -> Column:
    """Array of the separated fields, empty ones kept; NULL counts as one empty field."""
    return F.split(F.coalesce(as_column(value), F.lit("")), re.escape(separator), -1)
