"""URL filter: a blocked Bloom filter before an exact hash join with the listed URLs.

A rule is a canonical host and path; it fits its host and all subdomains where the
URL's path starts with the rule's. A URL is therefore tested under a few canonical
keys: each number of trailing host labels with each path length that the list holds
for that number. Their 64-bit hashes go through the filter, whose blocks are 512 bits:
one hash picks a block and a bit in each of its eight words, so a test touches one
cache line. Keys that pass are joined with the list itself, which removes the false
positives; the longest rule left decides.

The filter has ``BITS`` bits per rule up to ``MOST_BLOCKS`` blocks (64 MB, what is
broadcast at most). A longer list makes it pass more false positives, not wrong ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, ascii_lower

BITS = 16
MOST_BLOCKS = 1 << 20
_WORDS = 8  # of 64 bits


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(labels: Column, n: Column, path: Column, size: Column) -> Column:
    host = F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")
    return F.struct(host.alias("host"), F.substring(path, F.lit(1), size).alias("path"))


def bloom_blocks(hashes: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, w0..w7) of the filter that holds the given column ``h``."""
    block = F.pmod(F.shiftrightunsigned("h", 20), F.lit(blocks)).cast("int").alias("block")
    more = F.xxhash64(F.col("h"), F.lit(1))  # its six-bit pieces pick the bits
    bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(m, {6 * i}) & 63 as int))").alias(f"w{i}") for i in range(_WORDS)]
    rows = hashes.select(block, more.alias("m")).select("block", *bits)
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])


def _passing(urls: DataFrame, spark: SparkSession, table: np.ndarray, columns: list[str]) -> DataFrame:
    """Rows of ``urls`` with, in ``pass``, the places of the keys whose hashes (``hs``, ``ms``) pass."""
    shared = spark.sparkContext.broadcast(table)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        shifts = np.arange(0, 6 * _WORDS, 6, dtype=np.uint64)
        for part in parts:
            hs, ms = part.column("hs"), part.column("ms")
            h = hs.flatten().to_numpy().view(np.uint64)
            m = ms.flatten().to_numpy().view(np.uint64)
            block = held[(h >> np.uint64(20)) % np.uint64(len(held))]
            bits = np.uint64(1) << ((m[:, None] >> shifts) & np.uint64(63))
            hit = ((block & bits) == bits).all(1)
            sizes = np.diff(hs.offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=len(sizes)))]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(place[hit].astype(np.int32)))
            kept = [part.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, found], [*columns, "pass"])

    kept = urls.select(*columns).schema.fields
    return urls.mapInArrow(run, T.StructType([*kept, T.StructField("pass", T.ArrayType(T.IntegerType()))]))


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", scratch: Scratch | None = None
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, host, path, rule, verdict.

    ``rules`` has verdict, host and path. The rule with the longest host and path
    together wins, then the longer host; of equal rules that differ in the verdict,
    ``block``. A null url, or one without ``://``, has an empty host and path and gets
    ``default``, like any that no rule fits. Rules with a null host, path or verdict
    are none; an empty list leaves ``default``. Repeated pages keep a row each, a null
    page_id stays null, other columns are ignored.
    """
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark, "urls")
    listed = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").dropna()
    listed = listed.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block after allow
    listed = scratch(listed, "rules")
    shape = [F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("size")]
    shapes = listed.select(*shape).distinct().orderBy("labels", "size").collect()  # lengths of hosts and paths, not rules
    hashes = listed.select(F.xxhash64("host", "path").alias("h"))
    blocks = min(MOST_BLOCKS, 1 << max(0, (listed.count() * BITS - 1) // 512).bit_length())
    table = np.zeros((blocks, _WORDS), np.uint64)
    for row in bloom_blocks(hashes, blocks).toLocalIterator():  # bounded by MOST_BLOCKS
        table[row[0]] = np.array(row[1:], np.int64).view(np.uint64)

    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = urls.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = F.array(*[F.struct(F.lit(r.labels).alias("n"), F.lit(r.size).alias("s")) for r in shapes])
    known = known.cast("array<struct<n:int,s:int>>")
    labels = F.split("host", r"\.")
    fit = F.filter(known, lambda x: (x["n"] <= F.size(labels)) & (x["s"] <= F.length("path")))
    urls = urls.withColumn("keys", F.transform(fit, lambda x: _key(labels, x["n"], F.col("path"), x["s"])))
    urls = urls.withColumn("hs", F.transform("keys", lambda k: F.xxhash64(k["host"], k["path"])))
    urls = urls.withColumn("ms", F.transform("hs", lambda h: F.xxhash64(h, F.lit(1))))
    tested = _passing(urls, spark, table, ["page_id", "url", "host", "path", "keys"])
    # one row per key that passes, and one without a key so that every page stays
    places = F.concat(F.array(F.lit(None).cast("int")), F.col("pass"))
    keyed = tested.select("page_id", "url", "host", "path", "keys", F.explode(places).alias("place"))
    key = F.when(F.col("place").isNotNull(), F.get("keys", F.col("place") - 1))
    keyed = keyed.select("page_id", "url", "host", "path", "place", key["host"].alias("r_host"), key["path"].alias("r_path"))
    sought = scratch(keyed.where("place is not null"), "sought")
    exact = listed.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict"))
    found = sought.join(exact, ["r_host", "r_path"])
    rule = F.struct(
        F.length(F.concat("r_host", "r_path")).alias("size"),
        F.length("r_host").alias("h"),
        F.concat("r_host", "r_path").alias("rule"),
        "verdict",
    )
    own = keyed.where("place is null").select("page_id", "url", "host", "path", F.lit(1).alias("rows"), F.lit(None).alias("best"))
    best = found.select("page_id", "url", "host", "path", F.lit(0).alias("rows"), rule.alias("best"))
    judged = own.unionByName(best).groupBy("page_id", "url", "host", "path").agg(
        F.sum("rows").cast("int").alias("rows"), F.max("best").alias("best")
    )
    return judged.select(
        "page_id", "url", "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows"))).alias("_"),
    ).drop("_")
