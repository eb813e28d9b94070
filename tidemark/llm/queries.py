"""The registered queries of this package and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.html_text import extract
from tidemark.llm.mixing import mix
from tidemark.llm.periodic import periodic_runs
from tidemark.llm.pii import find_pii
from tidemark.llm.quality import classify
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.suffix_dedup import without_repeats
from tidemark.llm.token_counts import prefix_counts, totals
from tidemark.llm.tokens import token_output
from tidemark.llm.url_filter import judge
from tidemark.llm.vectors import near_vectors

# fixed values: verdict, then host and path of each rule
URL_RULES = (
    "allow com/",
    "block example.com/en/",
    "allow www.example.com/en/",
    "block net/es/",
    "block net/fr/",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


TOKEN_LIMIT = 4096  # fixed value of op12


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), tokenizer_file())


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([r.split(" ") for r in URL_RULES], "verdict string, rule string")
    rules = rules.select("verdict", F.substring_index("rule", "/", 1).alias("host"), F.expr("substr(rule, locate('/', rule))").alias("path"))
    found = judge(table(spark, sf_dir, "pages"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


@_query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


@_query
def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "perplexity", "threshold", "keep")


@_query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@_query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.expr("vec_id % 50 = 0"))


@_query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    stored = Scratch(spark, "prefix_counts")(counts, "slices", "zstd")
    return totals(stored).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted=True).drop("runs")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, w[s : s + least(len(w), 13) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, s, n, w[s : s + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)
),
found AS (SELECT doc_id, s, places.n, item_id FROM places JOIN wins ON places.n = wins.n AND places.win = wins.win),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM found)) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES["op2_url_filter"] = f"""
WITH rules(verdict, host, path) AS (
  VALUES {", ".join("('{}', '{}', '/{}')".format(r.split(" ")[0], *r.split(" ")[1].split("/", 1)) for r in URL_RULES)}
),
rest AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
),
urls AS (
  SELECT page_id, row_number() OVER () AS row, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
best AS (
  SELECT row, arg_max(rules.host || rules.path, length(rules.host || rules.path) * 1000 + length(rules.host)) AS rule,
         arg_max(verdict, length(rules.host || rules.path) * 1000 + length(rules.host)) AS verdict
  FROM urls JOIN rules ON (urls.host = rules.host OR ends_with(urls.host, '.' || rules.host))
    AND starts_with(urls.path, rules.path)
  GROUP BY row
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (row)
"""

ORACLES["op6_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
good AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
),
reach AS (
  SELECT vec_id, vec_id AS r FROM v UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a
),
low AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM low LEFT JOIN n USING (vec_id)
"""

ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q, row_number() OVER () AS nth
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.nth, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS alike,
         CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.nth <> v.nth AND len(a.q) = len(v.q) WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT nth, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY nth ORDER BY score DESC, vec_id) AS p
  FROM scores WHERE alike
),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY nth, p ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scores USING (nth, anchor_id)
  WHERE p <= 5 AND NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""
