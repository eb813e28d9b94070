"""Counts of every prefix against the library, and the questions the stored table answers."""

from __future__ import annotations

import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from tests.llm.test_against_brute import SF, same
from tests.llm.test_odd_rows import TEXTS, docs, none  # noqa: F401
from tidemark.llm import token_counts
from tidemark.llm.common import Scratch, table
from tidemark.llm.queries import QUERIES, TOKEN_LIMIT, tokenizer_file

FILE = tokenizer_file("piece_bpe_32k.model")
LETTERS = " ab▁\n\té日本😀aaa1 2.,-=#*<s>thein  \x00"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=FILE)


def test_every_prefix_of_random_texts(library):
    rng, count = random.Random(7), token_counts.PrefixCounter(FILE)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["a" * 300, "日本語" * 40, "=" * 100, " " * 50, "<unk></s><0x0A>", "▁▁ ▁", "internationalization" * 5]
    for text, steps in zip(texts, count(texts)):
        found = np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64).tolist()
        assert found == [len(library.encode(text[:k])) for k in range(1, len(text) + 1)], text


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_counts, "WORDS", 20)
    monkeypatch.setattr(token_counts, "PAIRS", 30)
    rng, count = random.Random(8), token_counts.PrefixCounter(FILE)
    for _ in range(50):
        text = " ".join("".join(rng.choice("abcdethin") for _ in range(6)) for _ in range(10))
        assert sum(np.frombuffer(count([text])[0], np.int8)) == len(library.encode(text))
        assert len(count._known) <= 20 and len(count._pairs) <= 30


def test_the_query(spark, library):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    wanted = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > TOKEN_LIMIT) for i, t in rows]
    same(QUERIES["op12_token_counts"](spark, SF).collect(), wanted)


def test_odd_rows(spark, docs, none, library):  # noqa: F811
    found = token_counts.totals(token_counts.prefix_counts(docs, FILE))
    same(found.collect(), [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in TEXTS])
    assert token_counts.prefix_counts(none, FILE).count() == 0


@pytest.mark.parametrize("slice_chars", [7, 1000, token_counts.SLICE])
def test_questions(spark, docs, library, slice_chars):  # noqa: F811
    counts = Scratch(spark, "counts")(token_counts.prefix_counts(docs, FILE, slice_chars), "slices")
    for chars in (0, 1, 7, 8, 150, 10**7):
        wanted = [(i, len(library.encode((t or "")[:chars]))) for i, t in TEXTS]
        same(token_counts.tokens_of_prefix(counts, chars).drop("row").collect(), wanted)
    short = [(i, t or "") for i, t in TEXTS if len(t or "") < 500]
    for budget in (0, 1, 3, 40, 10**6):
        best = [(i, max(k for k in range(len(t) + 1) if len(library.encode(t[:k])) <= budget)) for i, t in short]
        found = token_counts.longest_within(counts.where("n_chars < 500"), budget)
        same(found.drop("row").collect(), best)
