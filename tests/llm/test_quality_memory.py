"""What workers and writers hold at once while documents are scored."""

from __future__ import annotations

import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import common, quality

WORDS = [f"{a}{b}{c}" for a in ("ta", "mo", "ri", "sel") for b in ("n", "kel", "vu") for c in ("o", "ard", "is")]


def _text(seed: int, words: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=words))


def _parts(number: int, rows: int):
    for k in range(number):
        texts = [_text(k * rows + i, 300) for i in range(rows)]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([7] * rows, pa.int32()), "text": texts})


def _anon_mb() -> float:
    found = re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())
    return int(found[1]) / 1024


def test_a_chunk_asks_batch_by_batch():
    """Batches are taken one at a time, and the answer is the one their whole chunk has."""
    alive, most = [0], [0]

    class Counted:
        def __init__(self, part):
            self.part = part
            alive[0] += 1
            most[0] = max(most[0], alive[0])

        def column(self, name):
            return self.part.column(name)

        def __del__(self):
            alive[0] -= 1

    asked = list(quality._ask(Counted(p) for p in _parts(6, 50)))
    assert most[0] <= 2  # the one in hand, and the next as it comes
    found = pa.Table.from_batches(asked)
    assert set(found["chunk"].to_pylist()) == {7}
    longest = np.concatenate([g for p in _parts(6, 50) for _, _, g in quality._ngrams(quality._bytes(p.column("text")))])
    assert np.array_equal(found["gram"].to_numpy(), quality._needed(np.unique(longest)))


def test_scores_need_little_beside_the_texts():
    texts = pa.chunked_array([p.column("text") for p in _parts(8, 200)])
    grams = pa.Table.from_batches(quality._ask(_parts(8, 200)))["gram"]
    ones = pa.repeat(0.5, len(grams))
    answers = pa.table({"gram": grams, "kept": ones, "lam": ones})
    tracemalloc.start()
    try:
        scores = quality._log_perplexities(texts, answers)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(scores) == 1600 and np.isfinite(scores).all()
    assert peak < 35e6  # of it 17 for the table of places


def test_scored_texts_are_written_in_small_row_groups(spark):
    """A writer holds a row group, a reader takes it whole."""
    texts = [(i, "en", random.Random(i).randbytes(10_000).hex()) for i in range(2000)]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string")
    labels = spark.range(0, 2000, 7).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    scratch = common.Scratch(spark, "row-groups")
    assert quality.kept(docs, labels, scratch).count() > 0
    [scored] = Path(scratch.folder.removeprefix("file:")).glob("*_scored")
    sizes = [
        sum(group.column(c).total_compressed_size for c in range(group.num_columns))
        for meta in (pq.ParquetFile(f).metadata for f in scored.glob("*.parquet"))
        for group in map(meta.row_group, range(meta.num_row_groups))
    ]
    assert sum(sizes) > 30e6
    assert max(sizes) < 20e6


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="the system tells no memory")
def test_freed_memory_goes_back():
    held = [bytearray(100_000) for _ in range(2000)]
    tail = bytearray(100_000)  # keeps what lies below from going back by itself
    before = _anon_mb()
    del held
    common.release()
    assert tail is not None and _anon_mb() < before - 100
