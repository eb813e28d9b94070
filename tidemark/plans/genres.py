"""Genre tree: roots to ``genre``, children to ``style``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.apply import upsert
from tidemark.operators.joins import has_parent
from tidemark.operators.trees import tree_children, tree_roots
from tidemark.plans.context import Run, Tables, same_named


def sync_genre(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    roots = tree_roots(src["tmu_genre"], "genre_cd", "pgenre_cd").select(
        F.col("genre_cd").alias("genre_id"), "genre_nm"
    )
    return upsert(
        tgt["genre"],
        roots,
        ["genre_id"],
        on_match=same_named("genre_nm"),
        on_insert=same_named("genre_nm") | {"crt_dt": run.now},
        stage=run.stage,
    )


def sync_style(src: Tables, tgt: Tables, run: Run) -> DataFrame:
    """Styles are keyed by the parent code; only children known as genres count."""
    children = tree_children(src["tmu_genre"], "genre_cd", "pgenre_cd").select(
        F.col("pgenre_cd").alias("style_id"),
        F.col("genre_cd").alias("genre_id"),
        F.col("genre_nm").alias("style_nm"),
    )
    return upsert(
        tgt["style"],
        has_parent(children, tgt["genre"], ["genre_id"]),
        ["style_id"],
        on_match=same_named("style_nm"),
        on_insert=same_named("genre_id", "style_nm") | {"crt_dt": run.now},
        stage=run.stage,
    )
