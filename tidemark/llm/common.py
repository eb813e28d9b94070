"""What several operators share: written tables, bounded broadcasts, components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import Files
from tidemark.sources.staging import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes that are white space in every word definition of this package: \x20 and \x09-\x0D.
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared checkpoint folder: cut lineage that outlives executors.

    One folder per call of an operator. The frames an operator returns read from
    it, so its owner removes it (``folder``) once those results are stored.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._numbers = count(1)
        self._tables: list[tuple[DataFrame, str]] = []

    def path(self, label: str) -> str:
        return f"{self.folder}/{next(self._numbers):03d}_{label}"

    def __call__(
        self, df: DataFrame, label: str, compression: str = "snappy", row_group: int | None = None
    ) -> DataFrame:
        """``row_group``: bytes a writer gathers before it writes them; for tables of whole texts."""
        path = self.path(label)
        to = df.write if row_group is None else df.write.option("parquet.block.size", row_group)
        to.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._tables.append((out, path))
        return out

    def keep_only(self, *tables: DataFrame) -> None:
        """Removes every other table written so far; for a result that reads only these."""
        files, kept = Files(self.spark), []
        for one, path in self._tables:
            if any(one is t for t in tables):
                kept.append((one, path))
            else:
                files.remove(path)
        self._tables = kept

    def counted(self, df: DataFrame, label: str, *more: Column) -> tuple[DataFrame, dict]:
        """The written table and, from the same job, its row count ``n`` and other totals."""
        seen = Observation(f"{label}-{uuid.uuid4().hex}")
        out = self(df.observe(seen, F.count(F.lit(1)).alias("n"), *more), label)
        return out, seen.get


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, UPPER, LOWER)


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """Rows as ``row``, out of the way of other names, with what identifies a document: ``id``, ``hash``."""
    return docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
        *more,
    )


def same_document(left: str = "doc_id", right: str = "text_hash") -> Column:
    """A packed row's document is the one named by two columns; null ids are alike."""
    return F.col("id").eqNullSafe(F.col(left)) & F.col("hash").eqNullSafe(F.col(right))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one block as (id, smallest id of its group in the block), smallest left out."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    more = label != np.arange(len(ids))
    return ids[more], ids[label[more]]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of links ``a``, ``b``: every linked ``node`` with its ``root``.

    Alternating large-star and small-star rounds on written tables; a round costs
    a few shuffles of the links and their number is logarithmic in practice. Only
    counts reach the driver. The root is the smallest id of the component.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    now, seen = scratch.counted(pairs, "links", digest)
    while seen["n"]:
        both = now.union(now.select("b", "a"))
        low = scratch(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large_low")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch(large.where("a <> b").distinct(), "large")
        least = scratch(large.groupBy("a").agg(F.min("b").alias("m")), "small_low")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        step = small.union(least).distinct()
        new, then = scratch.counted(step, "small", digest)
        if then == seen:
            break
        now, seen = new, then
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def batches(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of ``size`` rows, the last one shorter."""
    kept: list = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield kept
            kept = []
    if kept:
        yield kept


def release() -> None:
    """Hands back freed memory that Arrow's pool and the C library keep.

    A worker may serve later stages or wait idle, and its executor has little to spare.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


def keep_oldest(known: dict, most: int) -> None:
    """Forgets the younger half beyond ``most`` entries: what is frequent was met early."""
    if len(known) > most:
        kept = list(islice(known.items(), most // 2))
        known.clear()
        known.update(kept)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started within hand Python workers that many rows at once.

    For tables of whole texts, whose batches would else take much of a worker's memory.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
