"""The quality classifier trains on every trusted document that is not held out, however many there are."""

from __future__ import annotations

import inspect

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.common import Scratch

ROWS = [(i, "en", f"text {i % 7} of document {i} " * (1 + i % 3)) for i in range(60)]


def made(spark):
    docs = spark.createDataFrame([*ROWS, (3, "en", "repeated id"), (None, "en", "no id")], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    return docs, labels


def counts(spark, monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK", block)
    docs, labels = made(spark)
    scratch = Scratch(spark, "test")
    found = {(r.doc_id, r.perplexity) for r in quality.classify(docs, labels, scratch).collect()}
    trusted = spark.read.parquet(f"{scratch.folder}/*_trusted").count()
    model = sorted(tuple(r) for r in spark.read.parquet(f"{scratch.folder}/*_model").collect())
    return found, trusted, model


def test_blocks_of_ids_give_the_same_model(spark, monkeypatch):
    docs, labels = made(spark)
    wanted = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(quality.HELD_OUT)) != 0).count()
    whole = counts(spark, monkeypatch, 1_000_000)
    parts = counts(spark, monkeypatch, 7)
    assert wanted > 40 and whole[1] == parts[1] == wanted
    assert [r[0] for r in whole[2]] == [r[0] for r in parts[2]]
    assert [x for r in parts[2] for x in r] == pytest.approx([x for r in whole[2] for x in r], rel=1e-12)
    assert dict(parts[0]) == pytest.approx(dict(whole[0]), rel=1e-9)


@pytest.mark.parametrize("call", [quality.classify, quality.kept])
def test_no_number_of_documents_is_the_most(call):
    assert inspect.signature(call).parameters["trusted"].default is None
