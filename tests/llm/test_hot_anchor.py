"""A passage in very many texts: the stretches of its anchor are cut by content, not held together."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_against_brute import same
from tidemark.llm import suffix_dedup

LETTERS = "abcdefghijklmnopqrstuvwxyz     "


@pytest.mark.parametrize("size", [90, 190, 199, 200, 230])
def test_no_shard_outgrows_its_bytes(spark, monkeypatch, size):
    most = 16_384
    monkeypatch.setattr(suffix_dedup, "SHARD", most)
    plain = suffix_dedup._sorted_out

    def watched(window):
        inner = plain(window)

        def run(parts):
            held = list(parts)
            found = sum(len(x) for part in held for x in part.column(3).to_pylist())
            if found > 8 * most:  # groups are dealt by hash: several meet in a shard
                raise MemoryError(f"{found} bytes in a shard")
            yield from inner(iter(held))

        return run

    monkeypatch.setattr(suffix_dedup, "_sorted_out", watched)
    rng = random.Random(size)

    def prose(n):
        return "".join(rng.choice(LETTERS) for _ in range(n))

    passage, near = prose(size), [prose(120) for _ in range(4)]
    texts = []
    for i in range(900):
        before = prose(rng.randint(150, 260)) if i % 3 else prose(60) + near[i % 4]
        after = prose(rng.randint(150, 260)) if i % 5 else near[i % 4][: rng.randint(1, 120)] + prose(80)
        texts.append((i, before + passage + after))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = suffix_dedup.without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    same(found.collect(), brute.unrepeated(texts))
