"""Run cut-off and time stamps."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import as_column

DEFAULT_OFFSET_DAYS = -1


def cutoff(as_of: datetime, offset_days: float | None = None) -> datetime:
    """Midnight of the day ``offset_days`` away from the run time."""
    days = DEFAULT_OFFSET_DAYS if offset_days is None else offset_days
    shifted = as_of + timedelta(days=days)
    return shifted.replace(hour=0, minute=0, second=0, microsecond=0)


def at(moment: datetime) -> Column:
    """A run time as a literal without time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight(value: Column | str) -> Column:
    return as_column(value).cast("date").cast("timestamp_ntz")


def stamp14(value: Column | str) -> Column:
    """Fourteen digits: year to second.

    Taken from the text of the time without zone, because a formatter would move
    times that the session's time zone skips.
    """
    text = as_column(value).cast("timestamp_ntz").cast("string")
    return F.translate(F.substring(text, 1, 19), "- :", "")


def changed(cut: datetime, *columns: str) -> Column:
    """Any of the dates lies strictly after the cut; NULL dates do not count."""
    return reduce(Column.__or__, [F.col(c) > at(cut) for c in columns])
