"""Session settings that hold while something runs."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_UNITS = "bkmgtp"

_lock = threading.Lock()
_users: dict[tuple[int, str], list] = {}  # by session and setting: how many hold it, what was there before


def number_of_bytes(text: str) -> int:
    """A size as Spark writes it, such as 10485760b, 256k or 10MB."""
    digits, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]?)b?\s*", text.lower()).groups()
    return int(digits) * 1024 ** _UNITS.index(unit or "b")


@contextmanager
def _held(spark: SparkSession, name: str, most: int) -> Iterator[None]:
    """The setting is ``most`` at most. Several threads may hold it; the last one puts back what was there."""
    key = id(spark), name
    with _lock:
        if key in _users:
            _users[key][0] += 1
        else:
            before = spark.conf.get(name)
            _users[key] = [1, before]
            if number_of_bytes(before) > most:
                spark.conf.set(name, str(most))
    try:
        yield
    finally:
        with _lock:
            _users[key][0] -= 1
            if not _users[key][0]:
                spark.conf.set(name, _users.pop(key)[1])


def broadcasts_of(spark: SparkSession, most: int):
    """Spark broadcasts no table that it takes to be larger; a smaller setting of the session stays."""
    return _held(spark, _BROADCAST, most)


def listing_tasks(spark: SparkSession, most: int):
    """Folders are listed in so many tasks at most, rather than in one for each."""
    return _held(spark, _LISTING, most)
