"""Held-out accuracy of the quality classifier, and the whole pipeline stage by stage."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_against_brute import same
from tidemark.llm import quality
from tidemark.llm.common import Scratch, table
from tidemark.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def grams(text):
    data = bytes(quality.ORDER - 1) + text.encode() + b"\0"
    return [data[i : i + quality.ORDER] for i in range(len(data) - quality.ORDER + 1)]


def kneser_ney(texts):
    """Interpolated modified Kneser-Ney over bytes, from dictionaries."""
    order = quality.ORDER
    counts = [{} for _ in range(order)]  # all but the longest by distinct predecessors
    for t in texts:
        for g in grams(t):
            counts[-1][g] = counts[-1].get(g, 0) + 1
    for k in range(order - 2, -1, -1):
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1
    tables = []
    for table_ in counts:
        n = [sum(1 for v in table_.values() if v == k) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        d = [min(k, max(0.1, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.5 * k for k in (1, 2, 3)]
        total, free = {}, {}
        for g, v in table_.items():
            total[g[:-1]] = total.get(g[:-1], 0) + v
            free[g[:-1]] = free.get(g[:-1], 0) + d[min(v, 3) - 1]
        tables.append((table_, d, total, free))

    def p(g):
        lower = p(g[1:]) if len(g) > 1 else 1 / 256
        table_, d, total, free = tables[len(g) - 1]
        if g[:-1] not in total:
            return lower
        v = table_.get(g, 0)
        kept = v - d[min(v, 3) - 1] if v else 0
        return (kept + free[g[:-1]] * lower) / total[g[:-1]]

    def perplexity(text):
        return math.exp(-sum(math.log(p(g)) for g in grams(text)) / len(grams(text)))

    return perplexity


def trained_on(docs, labels):
    """Ids of the documents that train the model."""
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(quality.HELD_OUT)) == 0
    return [r.text for r in docs.join(trusted.where(~held), "doc_id", "left_semi").collect() if r.text]


def test_perplexity_is_that_of_a_plain_model(spark):
    # the registered query, on its whole tables
    docs = table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    plain = kneser_ney(trained_on(docs, table(spark, SMALL, "labels")))
    found = QUERIES["op7_quality"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.perplexity == pytest.approx(plain(texts[r.doc_id]), rel=1e-9) if texts[r.doc_id] else r.perplexity is None


@pytest.mark.parametrize(("piece", "chunk"), [(64, 1 << 26), (1 << 22, 300)])
def test_pieces_and_chunks_make_no_difference(spark, monkeypatch, piece, chunk):
    rng = random.Random(3)
    texts = ["a", "日本", "~~~~", "", None, "x" * 70] + ["".join(rng.choice("ab c") for _ in range(rng.randrange(400))) for _ in range(40)]
    docs = spark.createDataFrame([(i if i % 3 else None, t, str(i)) for i, t in enumerate(texts)], "doc_id long, text string, `odd.name` string")
    trusted = texts[10:30]
    model = quality.train(spark.createDataFrame([(t,) for t in trusted], "text string"), Scratch(spark, "test"))
    plain = kneser_ney(trusted)
    monkeypatch.setattr(quality, "_PIECE", piece)
    monkeypatch.setattr(quality, "CHUNK", chunk)
    rows = quality.score(docs, model, whole=True).collect()
    assert sorted(int(r.row["odd.name"]) for r in rows) == list(range(len(texts)))
    for r in rows:
        assert r.text == texts[int(r.row["odd.name"])]
        assert math.exp(r.score) == pytest.approx(plain(r.text), rel=1e-9) if r.text else r.score is None


def test_texts_are_dealt_once_and_no_model_is_broadcast(spark, no_broadcast):
    docs = table(spark, SMALL, "documents")
    scratch = Scratch(spark, "test")
    model = quality.train(docs.select("text"), scratch)
    found = quality.score(docs, model, whole=True)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("ReusedExchange") == 1 and "BroadcastHashJoin" not in final and "SortMergeJoin" in final


def test_clean_documents_stay_and_junk_goes(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    # trained on even ids, judged on odd ones
    judged = quality.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rates = {(r.quality, r.toxic): r.kept for r in judged.groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert rates[1, 0] >= 0.97
    assert rates[0, 0] <= 0.1


def test_stages_of_the_pipeline(spark):
    scratch = Scratch(spark, "test")
    docs = table(spark, SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    out = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, scratch(stage(spark, docs, SMALL), f"stage{i}")
        out[name] = before, docs
        if name != names[-1]:
            assert docs.columns == before.columns
    texts = {n: ([(r.doc_id, r.text) for r in a.collect()], b.collect()) for n, (a, b) in out.items()}

    before, after = texts[names[0]]
    bad = {r.doc_id for r in quality.classify(out[names[0]][0], table(spark, SMALL, "labels")).where("not keep").collect()}
    assert {r.doc_id for r in after} == {i for i, _ in before} - bad
    before, after = texts[names[1]]
    assert {r.doc_id for r in after} == {c for _, _, c in brute.simhash_components(before)} and len(after) == len({r.doc_id for r in after})
    before, after = texts[names[2]]
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    assert {r.doc_id for r in after} == {w[0] for w in brute.contamination(before, items) if not w[-1]}
    before, after = texts[names[3]]
    known = dict(before)
    assert all(known[r.doc_id] == r.text for r in after)
    copies = {i: sum(r.doc_id == i for r in after) for i in known}
    assert max(copies.values()) <= 3
    before, after = texts[names[4]]
    library = Tokenizer.from_file(tokenizer_file())
    same(after, brute.token_rows(before, lambda t: library.encode(t, add_special_tokens=False).ids))
