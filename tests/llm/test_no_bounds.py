"""Inputs that earlier bounds lost: deep markup, cue spellings, common phrases, null ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_against_brute import same
from tidemark.llm import decontaminate, html_text, pii, tokens
from tidemark.llm.common import Scratch
from tidemark.llm.queries import tokenizer_file


@pytest.mark.parametrize("deep", [7, 8, 9, 500])
def test_a_paragraph_closes_one_of_any_depth(deep):
    found = html_text.blocks('<p class="promo">Buy' + "<b>" * deep + "<p>The main text of it")
    assert [b[0] for b in found] == ["Buy", "The main text of it"]
    assert [b[3] for b in found] == [1, 0]


@pytest.mark.parametrize(
    "text, value",
    [
        ("User ID: 12345678", "12345678"), ("Tax ID: 123456789", "123456789"), ("ApiKey: abcd12345678", "abcd12345678"),
        ("apiKey: abcd12345678", "abcd12345678"), ("Api_Key = abcd12345678", "abcd12345678"), ("pAsSwOrD:     a1b2c3d4e5", "a1b2c3d4e5"),
        ("password: hunter-twelve", "hunter-twelve"), ('"password": "hunter-twelve"', "hunter-twelve"), ("the password is required", None),
        ("İİ USERNAME: x12345", "x12345"), ("tokens 12345678", None),
    ],
)
def test_cues_of_any_spelling(text, value):
    assert [text[a:b] for a, b in pii.spans(text)["account"]] == ([value] if value else [])


def test_addresses_of_any_length():
    scheme = "scheme-" * 20 + "x"
    text = f"see {scheme}://me:pw@host.example and tel:+{'1' * 40}"
    assert [text[a:b] for a, b in pii.spans(text)["address"]] == [f"{scheme}://me:pw@host.example", f"tel:+{'1' * 40}"]


def test_a_common_phrase_writes_no_candidates(spark):
    phrase = "one two three four five six"
    docs = [(i, f"{phrase} w{i} {phrase}") for i in range(300)]
    items = [(1, f"{phrase} seven eight nine ten eleven twelve thirteen"), (2, f"{phrase} w7"), (3, "eleven twelve")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    scratch = Scratch(spark, "t")
    found = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), scratch=scratch)
    same(found.drop("text_hash").collect(), brute.contamination(docs, items))
    written = spark.read.parquet(f"{scratch.folder}/*_candidates")
    assert written.count() == 1  # the one place of the second item


def test_null_ids_spread_over_parts(spark, tmp_path):
    rows = [(None if i % 3 == 0 else i, f"text {i * 7919 % 1000} of many") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    parts = tokens.write_store(df, f"file://{tmp_path}/store", tokenizer_file(), parts=16).collect()
    assert sum(p.n_docs for p in parts) == 3000 and max(p.n_docs for p in parts) < 500
    found = tokens.read_store(spark, f"file://{tmp_path}/store").where(F.col("doc_id").isNull())
    assert found.count() == 1000
