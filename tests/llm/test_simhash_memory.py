"""What a worker holds at once while fingerprints are made and compared."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from tests.conftest import rows
from tidemark.llm import simhash

TEXTS = ["id as doc_id", "concat_ws(' ', 'one two three', cast(id div 2 as string), 'four five') as text"]


@pytest.fixture()
def batch_rows(spark, tmp_path, monkeypatch):
    """The number of rows of each batch of texts that workers were given, by a file for each."""
    seen = tmp_path / "batches"
    seen.mkdir()
    plain = simhash.fingerprints

    def noted(docs, *more):
        def run(parts):
            for k, part in enumerate(parts):
                (seen / f"{part.column(0)[0].as_py()}_{k}").write_text(str(part.num_rows))
                yield part

        return plain(docs.mapInArrow(run, docs.schema), *more)

    monkeypatch.setattr(simhash, "fingerprints", noted)
    return lambda: [int(p.read_text()) for p in seen.iterdir()]


@pytest.mark.parametrize("run", [simhash.near_duplicates, simhash.representatives])
def test_texts_come_in_small_batches(spark, batch_rows, run):
    docs = spark.range(0, 4000, 1, 1).selectExpr(*TEXTS)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    run(docs).count()
    assert sum(batch_rows()) == 4000
    assert max(batch_rows()) <= 1000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_the_size_of_a_batch_changes_no_row(spark, monkeypatch):
    docs = spark.range(0, 500, 1, 2).selectExpr(*TEXTS)
    whole = rows(simhash.near_duplicates(docs))
    monkeypatch.setattr(simhash, "_ROWS", 3)
    assert rows(simhash.near_duplicates(docs)) == whole


def test_a_full_bucket_of_near_copies_is_compared_in_little_memory():
    """All 4,096 patterns of twelve bits, every pair of them linked."""
    fps = np.arange(simhash.BUCKET, dtype=np.int64) << 20
    tracemalloc.start()
    try:
        node, low = simhash._near(fps, 12)  # every pair links
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(node, fps[1:]) and not low.any()
    assert peak < 150e6


def test_links_become_groups_before_they_pile_up(monkeypatch):
    rng = np.random.default_rng(7)
    fps = np.unique(rng.integers(0, 1 << 14, 3000))
    node, low = simhash._near(fps, 2)
    monkeypatch.setattr(simhash, "_PAIRS", 64)
    some, lowest = simhash._near(fps, 2)
    assert np.array_equal(some, node) and np.array_equal(lowest, low)
