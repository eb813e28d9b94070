"""Periodic runs against their definition, and the transforms against plain sums."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import periodic_brute as plain
from tests.llm.test_against_brute import SF, same
from tests.llm.test_odd_rows import TEXTS, docs, none  # noqa: F401
from tidemark.llm import periodic
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES


def word_lists(rng: random.Random, n: int):
    """Random words, powers, powers of powers, broken and overlapping ones."""
    for _ in range(n):
        letters = rng.choice(["ab", "abc", "abcdefghijklmnop"])
        some = lambda k: [rng.choice(letters) for _ in range(k)]  # noqa: E731, B023
        w = some(rng.randint(0, 40))
        for _ in range(rng.randint(0, 4)):
            part = some(rng.choice([1, 2, 3, 5, 8, 13, 30, 60]))
            if rng.random() < 0.5:  # a period that itself holds a run
                part = part * rng.randint(3, 30) + some(rng.randint(1, 3))
            w += (part * 12)[: int(len(part) * rng.uniform(2.5, 6))] + some(rng.randint(0, 20))
            if rng.random() < 0.3 and w:
                w[rng.randrange(len(w))] = "x"
        yield w[:700]


@pytest.mark.parametrize("seed", range(4))
def test_random_words(seed):
    texts = [*word_lists(random.Random(seed), 60), [], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 500]
    number: dict = {}
    x = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for text, found in zip(texts, periodic.find_runs(x, bounds)):
        assert [tuple(map(int, r)) for r in found] == plain.runs(text), text


@pytest.mark.parametrize("block, top", [(8, 3), (8, 10**6), (64, 10**5), (256, 2**20)])
def test_occurrences_are_exact(block, top):
    rng = np.random.default_rng(block)
    windows = rng.integers(0, top, (20, 3 * block))
    for i in range(15):
        d = int(rng.integers(1, 2 * block))
        for k in range(0, 3 * block - d):
            windows[i, d + k] = windows[i, k]
    windows[3, 2 * block] += 1
    if top > 10**4:  # differences whose squares add up to a multiple of the first prime
        windows[16] = 0
        windows[16, block : 3 * block] = 1
    wanted = [[bool((w[:block] == w[d : d + block]).all()) for d in range(1, 2 * block)] for w in windows]
    assert periodic.occurrences(windows, block).tolist() == wanted


def test_multiples_of_a_prime_are_no_match(monkeypatch):
    monkeypatch.setattr(periodic, "PRIMES", ((97, 5), (193, 5)))  # 97 = 3 * 32 + 1, 193 = 3 * 64 + 1
    windows = np.zeros((1, 24), np.int64)
    windows[0, 8:12] = [9, 4, 0, 0]  # 9^2 + 4^2 = 97
    found = periodic.occurrences(windows, 8)
    wanted = [bool((windows[0, :8] == windows[0, d : d + 8]).all()) for d in range(1, 16)]
    assert found[0].tolist() == wanted


def test_the_query(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    short = [r for r in rows if len((r[1] or "").split()) < 1500]
    assert len(short) > 0.9 * len(rows)
    ids = {r[0] for r in short}
    found = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()]
    assert len(found) == len(rows)
    same([r for r in found if r[0] in ids], [plain.row(*r) for r in short])


def test_odd_rows(spark, docs, none, monkeypatch):  # noqa: F811
    kinds = [(i, t) for i, t in TEXTS if len(t or "") < 100_000]
    short = docs.where("text is null or length(text) < 100000")
    wanted = [plain.row(i, t) for i, t in kinds]
    same(periodic.periodic_runs(short, planted=True).drop("runs").collect(), wanted)
    monkeypatch.setattr(plain, "planted", lambda _, w: w)
    same(periodic.periodic_runs(short).drop("runs").collect(), [plain.row(i, t) for i, t in kinds])
    assert periodic.periodic_runs(none).count() == 0


def test_a_long_text(spark):
    rng = random.Random(3)
    part = [f"w{rng.randrange(5000)}" for _ in range(40_000)]
    text = " ".join(["head"] + part * 3 + ["x"] + ["a", "b"] * 30_000 + ["tail"])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = periodic.periodic_runs(df).first()
    assert [tuple(r) for r in row.runs] == [(1, 120_000, 40_000), (120_002, 60_000, 2)]
