"""Status and flag expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import as_column

ACTIVE = "A"
DELETED = "D"
OK = "OK"
BLIND = "BLIND"
YES = "Y"
NO = "N"


def yes_no(value: Column | str) -> Column:
    """A missing flag counts as ``'N'``."""
    return F.coalesce(as_column(value), F.lit(NO))


def status_of(*codes: Column | str, approved: Column | str | None = None) -> Column:
    """``'OK'`` when every row code is active (and approved, if asked), else ``'BLIND'``."""
    terms = [as_column(c) == ACTIVE for c in codes]
    if approved is not None:
        terms.append(yes_no(approved) == YES)
    return F.when(reduce(Column.__and__, terms), F.lit(OK)).otherwise(F.lit(BLIND))


def any_right(services: tuple[int, ...], service: str = "service_id", right: str = "right_yn") -> Column:
    """A right is held for at least one of the services."""
    return F.col(service).isin(*services) & (F.col(right) == YES)
