"""Benchmark decontamination: which words of a document stand in benchmark windows.

A prefix-filtered set join in DataFrame operations alone. An item falls into windows
of ``window`` consecutive words (a shorter item is one window), a window into
shingles of ``shingle`` words, ordered by how often the corpus holds them. A window
that must be contained whole shares every shingle with its place, so the necessary
prefix is its single rarest shingle: that token is joined, the place must lie inside
the document (position and length bounds), and the words there are compared with the
window's.

Shingles are hashed once and written with their documents. One pass over the hashes
counts those the benchmark has; the counts choose each window's prefix, and a second
pass looks for prefixes alone. Words are compared in the documents that have one. The
benchmark side is broadcast in blocks of a fixed size; a larger benchmark takes more
passes over the hashes, never a larger broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, ascii_lower, packed, same_document

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 5
SHARE = 20  # contaminated from one hit word in so many
BLOCK_ROWS = 100_000  # windows broadcast at once
BLOCK_BYTES = 32 << 20  # and their characters
_KEY = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    found = F.regexp_extract_all(ascii_lower(text.cast("string")), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _shingles(of: Column, k: int) -> Column:
    """Hashes of the runs of k words; the hash covers k and each word on its own."""

    def at(i: Column) -> Column:
        return F.xxhash64(F.lit(k), *[F.get(of, i + j) for j in range(k)])

    none = F.array().cast("array<bigint>")
    return F.when(F.size(of) >= k, F.transform(F.sequence(F.lit(0), F.size(of) - k), at)).otherwise(none)


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, win, words, len): the windows of every item with words."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w"))
    cut = F.when(
        F.size("w") >= window,
        F.transform(F.sequence(F.lit(0), F.size("w") - window), lambda i: F.slice("w", i + 1, window)),
    ).when(F.size("w") > 0, F.array("w"))
    rows = items.select("item_id", F.explode(cut).alias("words"))
    return rows.select("item_id", F.array_join("words", " ").alias("win"), "words", F.size("words").alias("len")).distinct()


def _hashed(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """Number of words and, for each length, the shingle hashes of every document."""
    lists = [F.struct(F.lit(k).alias("k"), _shingles(F.col("w"), k).alias("hs")) for k in lengths]
    tokens = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), words(F.col("text")).alias("w"))
    return tokens.select(*_KEY, F.size("w").alias("n_words"), F.array(*lists).alias("lists"))


def _met(hashed: DataFrame, listed: DataFrame) -> DataFrame:
    """The shingles of documents that a bounded list has, with their places."""
    rows = hashed.select(*_KEY, "n_words", F.inline("lists"))
    rows = rows.select(*_KEY, "n_words", F.posexplode("hs").alias("pos", "h"))
    return rows.join(F.broadcast(listed), "h")


def _places(docs: DataFrame, hashed: DataFrame, block: DataFrame, scratch: Scratch) -> DataFrame:
    """Verified places of a block of windows: key, start, end, win.

    Shingles are counted first, which leaves a number for each; only the rarest one of
    a window, and of windows all of whose shingles occur, is then looked for in documents.
    """
    shingles = block.select("win", F.posexplode("hs").alias("offset", "h"))
    counts = _met(hashed, shingles.select("h").distinct()).groupBy("h").agg(F.count(F.lit(1)).alias("times"))
    counts = scratch(counts, "rarity")
    prefix = (
        shingles.join(counts, "h", "left")
        .groupBy("win")
        .agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "h", "offset")).alias("rarest"))
        .where("rarest.times > 0")
        .select("win", "rarest.h", "rarest.offset")
    )
    prefix = scratch(prefix.join(block.select("win", "len"), "win"), "prefix")
    start = F.col("pos") - F.col("offset")
    near = _met(hashed, prefix).withColumn("start", start)
    near = near.where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
    near = scratch(near.select(*_KEY, "start", "len", "win").distinct(), "candidates")
    # words are taken again, of the documents with a candidate only
    named = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), "text")
    some = _joined(named, scratch(near.select(*_KEY).distinct(), "candidate_documents"), "left_semi")
    found = _joined(some.select(*_KEY, words(F.col("text")).alias("w")), near, "inner")
    found = found.where(F.array_join(F.slice("w", F.col("start") + 1, F.col("len")), " ") == F.col("win"))
    return found.select(*_KEY, "start", (F.col("start") + F.col("len")).alias("end"), "win").distinct()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    share: int = SHARE,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated from one hit word in ``share``. A null text has no
    words, as an empty one; documents and items without words meet nothing. A document
    is its doc_id (null included) and text: repeated rows each get the same result.
    Repeated items count once per item_id; an item without item_id marks words but is
    no counted item. An empty benchmark hits nothing. Other columns are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
    items = scratch(windows(benchmark, window), "windows")
    k_of = F.least("len", F.lit(shingle))
    distinct = items.select("win", "words", "len").distinct().withColumn("k", k_of)
    hs = [(k, _shingles(F.col("words"), k)) for k in range(1, shingle + 1)]
    hashed = reduce(lambda tail, x: F.when(F.col("k") == x[0], x[1]).otherwise(tail), hs, F.lit(None).cast("array<bigint>"))
    wins = scratch(distinct.withColumn("hs", hashed), "shingled")
    n, chars, lengths = wins.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("win")), F.lit(0)), F.collect_set("k")
    ).first()
    lengths = sorted(lengths, reverse=True) or [shingle]  # at most ``shingle`` of them
    blocks = max(1, -(-n // BLOCK_ROWS), -(-chars // BLOCK_BYTES))
    hashed = scratch(_hashed(docs, lengths), "hashed")
    own = hashed.select(*_KEY, "n_words")
    places = []
    for b in range(blocks):
        block = wins.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == b) if blocks > 1 else wins
        places.append(_places(docs, hashed, block, scratch))
    found = scratch(reduce(DataFrame.union, places), "places")

    before = W.partitionBy(*_KEY).orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    runs = found.groupBy(*_KEY, "start").agg(F.max("end").alias("end"))
    reach = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    runs = runs.select(*_KEY, F.greatest(F.lit(0), F.col("end") - reach).alias("gain"))
    covered = runs.groupBy(*_KEY).agg(F.sum("gain").alias("n_hit"))
    named = found.select(*_KEY, "win").distinct().join(items.select("win", "item_id"), "win")
    named = named.groupBy(*_KEY).agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    # staged, so that the join below is planned on what little there is
    hit = scratch(_joined(covered, named, "inner").select(*_KEY, "n_hit", "ids"), "hit")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return _joined(own, hit, "left").select(
        *_KEY,
        F.col("n_words").cast("long"),
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(ids), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({c: f"_{c}" for c in _KEY})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("text_hash").eqNullSafe(F.col("_text_hash"))
    return left.join(right, same, how).drop("_doc_id", "_text_hash")  # a semi join has neither


def without_contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` less its contaminated rows, columns as they are, whatever their names.

    Null and empty texts stay; repeated rows stay or go together; no rows give none.
    """
    own = scratch is None
    scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
    judged = decontaminate(docs, benchmark, scratch=scratch)
    bad = scratch(judged.where("contaminated").select(*_KEY).distinct(), "bad")
    if own:
        scratch.keep_only(bad)
    return packed(docs).join(bad, same_document(), "left_anti").select("row.*")
