"""Thresholds of the quality classifier: from which documents they come, and for whom they hold."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.common import Scratch, table

SF = "/root/testdata/sf0.01"


def test_thresholds_cover_all_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = labels.where("quality = 1 and toxic = 0").select("doc_id")
    held = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(quality.HELD_OUT)) == 0)
    wanted = docs.where("length(text) > 0").join(held, "doc_id").count()
    scratch = Scratch(spark, "test")
    quality.classify(docs, labels, scratch, trusted=20)  # bounds the training alone
    assert spark.read.parquet(f"{scratch.folder}/*_classes").agg(F.sum("n")).first()[0] == wanted
    assert spark.read.parquet(f"{scratch.folder}/*_trusted").count() == 20


def test_each_language_has_its_own_threshold_at_any_size(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = quality.classify(docs, labels).select("lang", "threshold").distinct().collect()
    limits = {r.lang: r.threshold for r in found}
    assert len(found) == len(limits) == len(set(limits.values())) == 4
    assert limits["es"] > limits["en"]


def test_few_documents_lean_on_all_languages(spark):
    # English lies at 1.0 to 1.1, German at 2.0; the more German ones, the less English matters
    def limits(german):
        rows = [(i, "en", 1.0 + i % 100 / 1000) for i in range(1000)] + [(1000 + i, "de", 2.0) for i in range(german)]
        rows += [(-1, "fr", 1.0)]
        scored = spark.createDataFrame(rows, "doc_id long, language string, score double")
        held = scored.where("doc_id >= 0").select("doc_id")
        return {r.language: r.limit for r in quality._thresholds(scored, held, Scratch(spark, "test")).collect()}

    none, some = limits(0), limits(3)
    assert none["fr"] >= none["en"]
    assert some["en"] < 1.5 < some["de"]
    assert limits(60)["de"] >= 2.0


def test_text_too_easy_to_foresee_goes(spark):
    rng = random.Random(7)
    words = ["the"] * 300 + ["".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(2, 9))) for _ in range(700)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(120)), "en") for i in range(600)]
    junk = [(1000, "the " * 300, "en"), (1001, "the " * 20, "en")]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    labels = docs.where("doc_id < 400").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(found[i].perplexity < found[i].threshold and not found[i].keep for i in (1000, 1001))
    assert sum(found[i].keep for i in range(400, 600)) >= 0.97 * 200
    left = {r.doc_id for r in quality.kept(docs, labels).collect()}
    assert left == {i for i, r in found.items() if r.keep}


def kind(text):
    words = text.split()
    if max(map(words.count, set(words)), default=0) >= 0.3 * len(words):
        return "one word"
    if text.count("!!") > 5:
        return "shouted"
    return "signs" if sum(map(text.count, ("%%%", "$$$", "###", "&&&", "***"))) > 5 else "other"


def test_junk_goes_by_kind(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    judged = quality.classify(docs, labels).join(labels.where("quality = 0"), "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    kept = {}
    for r in judged.collect():
        kept.setdefault(kind(r.text), []).append(r.keep)
    for name in ("one word", "shouted", "signs"):
        assert len(kept[name]) >= 10 and sum(kept[name]) <= 0.1 * len(kept[name]), name
