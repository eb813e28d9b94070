"""Hard negatives against all scores, the curve, and how many blocks are read."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_against_brute import SF, same
from tidemark.llm import hard_negatives as mined
from tidemark.llm.common import Scratch, table
from tidemark.llm.queries import QUERIES


def brute(rows: list[tuple], every: int, positives: int = 5, negatives: int = 3) -> list[tuple]:
    good = [
        (i, label, [math.floor(256 * x) for x in e])
        for i, label, e in rows
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    found = []
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    for n, (anchor, label, a) in enumerate(good):
        if anchor is None or anchor % every:
            continue
        scored = [
            (i, sum(p * q for p, q in zip(a, e)), other == label)
            for m, (i, other, e) in enumerate(good)
            if m != n and len(e) == len(a)
        ]
        near = sorted([s for s in scored if s[2]], key=order)[:positives]
        for positive, ps, _ in near:
            far = [s for s in scored if not s[2] and 50 * ps <= 100 * s[1] <= 95 * ps]
            for rank, (negative, ns, _) in enumerate(sorted(far, key=order)[:negatives], 1):
                found.append((anchor, positive, rank, negative, ps, ns))
    return found


def test_the_query(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    same(QUERIES["op11_hard_negatives"](spark, SF).collect(), brute(rows, 50))


def clustered(rng: random.Random, n: int, dims: int) -> list[tuple]:
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(8)]
    return [(i, rng.randrange(4), [x + rng.gauss(0, 0.1) for x in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("block", [1, 7, 256])
def test_blocks_of_any_size(spark, block):
    rng = random.Random(block)
    rows = clustered(rng, 300, 5) + [(1000 + i, 9, [0.5] * 5) for i in range(40)] + [(2000 + i, 8, [0.45] * 5) for i in range(40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = mined.hard_negatives(df, F.expr("vec_id % 10 = 0"), block=block)
    same(found.collect(), brute(rows, 10))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(2)
    rows = clustered(rng, 80, 4) + [
        (100, None, [1.0] * 4), (110, 1, None), (120, 1, [1.0, None, 0.0, 0.0]), (130, 1, [nan, 0.0, 0.0, 0.0]), (140, 1, [inf, 0.0, 0.0, 0.0]),
        (None, 1, [1.0, 1.0, 1.0, 1.0]), (None, 2, [0.9, 0.9, 0.9, 0.9]), (150, 1, []), (151, 1, []), (152, 2, []), (160, 1, [1.0, 2.0]),
        (161, 1, [1.0, 2.1]), (162, 2, [0.7, 1.5]), (170, 3, [0.0] * 4), (180, 1, [3000.0, 1.0, 0.0, -2.0]), (181, 2, [1500.0, 2.0, 0.0, 2.0]),
    ]
    rows += [rows[0]] * 3 + [rows[10]] * 2
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for c in ("anchor", "q", "key", "block", "dims", "n", "w", "score", "id", "rank", "group", "lo"):
        df = df.withColumn(c, F.lit(1))
    anchor = F.expr("vec_id % 10 = 0")
    same(mined.hard_negatives(df, anchor).collect(), brute(rows, 10))
    assert mined.hard_negatives(df.where("false"), anchor).count() == 0
    assert mined.hard_negatives(df, F.lit(False)).count() == 0


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, i % 3, [rng.uniform(-9e4, 9e4) for _ in range(6)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    same(mined.hard_negatives(df, F.expr("vec_id % 5 = 0"), block=16).collect(), brute(rows, 5))
    with pytest.raises(ValueError):
        mined.hard_negatives(df.select("vec_id", "label", F.transform("embedding", lambda x: x * 1e9).alias("embedding")), F.lit(True))


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = mined.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[np.array(sorted(range(len(keys)), key=keys.__getitem__))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_blocks_out_of_reach_are_not_read(spark, monkeypatch):
    rng = random.Random(6)
    rows = clustered(rng, 3000, 6)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    read = []
    chosen = mined._Mine._chosen

    def counted(self, groups, same, best):
        found = chosen(self, groups, same, best)
        if not best:
            read.append((found.count(), groups.count() * self._blocks.count()))
        return found

    monkeypatch.setattr(mined, "GROUP", 8)
    monkeypatch.setattr(mined._Mine, "_chosen", counted)
    found = mined.hard_negatives(df, F.expr("vec_id % 100 = 0"), block=16, scratch=Scratch(spark, "t"))
    same(found.collect(), brute(rows, 100))
    (near, all_near), (far, all_far) = read
    assert near < 0.2 * all_near and far < 0.5 * all_far, read
