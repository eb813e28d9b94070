"""Every registered query of the subpackage against its plain version, whole tables."""

from __future__ import annotations

import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES, URL_RULES, tokenizer_file

SF = "/root/testdata/sf0.001"


def same(found, wanted):
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, wanted), key=key)


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


def test_decontamination(spark, docs):
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    same(QUERIES["op1_decontaminate"](spark, SF).collect(), brute.contamination(docs, items))


def test_urls(spark):
    rules = [(v, r.split("/", 1)[0], "/" + r.split("/", 1)[1]) for v, r in (x.split(" ") for x in URL_RULES)]
    pages = table(spark, SF, "pages").select("page_id", "url").collect()
    same(QUERIES["op2_url_filter"](spark, SF).collect(), [(p, *brute.judged(u, rules)) for p, u in pages])


def test_simhash(spark, docs):
    same(QUERIES["op3_simhash"](spark, SF).collect(), brute.simhash_components(docs))


def test_suffixes(spark, docs):
    same(QUERIES["op4_suffix_dedup"](spark, SF).collect(), brute.unrepeated(docs))


def test_pii(spark, docs):
    same(QUERIES["op5_pii"](spark, SF).drop("spans").collect(), brute.pii(docs))


def test_vectors(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    same(QUERIES["op6_vectors"](spark, SF).collect(), brute.cosine_links(rows))


def test_tokens(spark, docs):
    library = Tokenizer.from_file(tokenizer_file())
    wanted = brute.token_rows(docs, lambda t: library.encode(t, add_special_tokens=False).ids)
    same(QUERIES["op9_tokens"](spark, SF).collect(), wanted)


def test_mixing(spark):
    rows = QUERIES["op10_mixing"](spark, SF).collect()
    again = QUERIES["op10_mixing"](spark, SF).collect()
    same(rows, again)
    source = dict(table(spark, SF, "documents").select("doc_id", "source").collect())
    sizes, taken = {}, {}
    for r in rows:
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    goals = brute.targets(sizes)
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(goals[source[r.doc_id]])
    smallest = {s: min(r["size"] for r in rows if source[r.doc_id] == s) for s in sizes}
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= max(smallest[s], 0.02 * goal), (s, taken[s], goal)
