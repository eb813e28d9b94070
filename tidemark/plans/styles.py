"""Which style rows a run has to look at."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.changes import changed_since
from tidemark.operators.joins import distinct_keys, has_parent
from tidemark.plans.context import Run, Tables


def changed_styles(src: Tables, name: str, key: str, region: DataFrame, run: Run) -> DataFrame:
    """New style rows, staged; for the generic sync every style row of an id that
    has a new one and a region row."""
    fresh = changed_since(run.recent(src, name), run.cut, ("crt_dt",))
    if run.region.regional:
        return run.stage(fresh, f"style_rows_{key}")
    candidates = run.stage(distinct_keys(fresh, [key]), f"style_candidates_{key}")
    ids = has_parent(region.select(key), candidates, [key]).distinct()
    rows = has_parent(src[name], run.stage(ids, f"style_ids_{key}"), [key])
    return run.stage(rows, f"style_rows_{key}")
