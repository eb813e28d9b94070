"""SimHash near-duplicates through covering locality-sensitive hashing.

Bit i of a fingerprint is given the vector m(i) = 1 + i mod 15 of GF(2)^4. Mask v
(1..15) holds the bits with <m(i), v> = 1. The vectors of up to three differing
bits span at most three of the four dimensions, so some v is orthogonal to all of
them: mask v holds none of those bits, and the two fingerprints agree on it. Every
pair within the radius therefore collides in one of 15 tables; no pair is missed.

A bucket beyond ``BUCKET`` fingerprints is covered once more over the bits its mask
leaves free. Such an inner bucket fixes all but 16 bits at most, which bounds it by
its width whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_rows, components, packed, release, same_document, stars

RADIUS = 3
SHINGLE = 3
SEED = 42
BUCKET = 4096
_CHUNK = 1 << 16  # shingles unpacked to bits at once
_ROWS = 1000  # texts a worker holds at once
_PAIRS = 1 << 20  # fingerprints compared at once, and links kept before they become groups


def masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """The covering masks over the given bit positions, as unsigned integers."""
    top = (1 << (radius + 1)) - 1
    return [sum(1 << b for i, b in enumerate(bits) if ((1 + i % top) & v).bit_count() & 1) for v in range(1, top + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def simhash(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text given as UTF-8; nothing or no word gives zero."""
    # bytes.lower changes A-Z alone, bytes.split cuts at \x20 and \x09-\x0D alone
    words = (data or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = words[at : at + min(_CHUNK, n - at) + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [part]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Columns ``doc_id``, ``text_hash``, ``fp`` (the 64 bits as a signed long), one row per row of docs."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what an earlier stage left in this worker
        for part in parts:
            texts = part.column(2).cast(pa.binary())
            found = np.fromiter((simhash(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            columns = [part.column(0), part.column(1), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # unsigned: of a negative number, the bits of its absolute value would be counted
    return np.bitwise_count((a ^ b).view(np.uint64))


def _near(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups among the fingerprints of one bucket, compared in blocks."""
    a, b, held = [], [], 0
    step = max(1, _PAIRS // len(fps))
    for at in range(0, len(fps), step):
        rows = fps[at : at + step]
        i, j = np.nonzero(_distance(rows[:, None], fps[None, at:]) <= radius)
        low = i < j
        x, y = stars(rows[i[low]], fps[at:][j[low]])
        a.append(x)
        b.append(y)
        held += len(x)
        if held > _PAIRS:  # as groups they are fewer than the fingerprints
            x, y = stars(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
    return stars(np.concatenate(a), np.concatenate(b))


def _links(radius: int):
    """Links in rows sorted by bucket (columns k, m, fp); a bucket may run over batches."""

    def groups(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left = np.zeros((3, 0), np.int64)
        for part in parts:
            rows = np.concatenate([left, [part.column(c).to_numpy() for c in range(3)]], axis=1)
            cuts = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
            if not len(cuts):
                left = rows
                continue
            yield rows[2, : cuts[-1]], cuts
            left = rows[:, cuts[-1] :]
        yield left[2], np.array([left.shape[1]])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, cuts in groups(parts):
            starts = np.concatenate([[0], cuts[:-1]])
            sizes = cuts - starts
            pairs = starts[sizes == 2]
            pairs = pairs[_distance(fps[pairs], fps[pairs + 1]) <= radius] if len(pairs) else pairs
            a, b = [fps[pairs]], [fps[pairs + 1]]
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                x, y = _near(fps[s : s + n], radius)
                a.append(x)
                b.append(y)
            x, y = stars(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
        release()

    return run


def _bucketed(keyed: DataFrame, radius: int) -> DataFrame:
    dealt = keyed.repartition("k", "m").sortWithinPartitions("k", "m")
    return dealt.select("k", "m", "fp").mapInArrow(_links(radius), "a long, b long")


def links(fps: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """Links between distinct fingerprints ``fp`` that connect all within the radius."""
    every = range(64)
    outer = masks(list(every), radius)
    tables = [F.struct(F.lit(v).cast("long").alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("m")) for v, m in enumerate(outer)]
    keyed = fps.select("fp", F.inline(F.array(*tables)))
    sizes = keyed.groupBy("k", "m").count().where("count > 1")
    sizes = scratch(sizes, "buckets")  # buckets of one have no pair
    rows = keyed.join(sizes, ["k", "m"])
    found = _bucketed(rows.where(F.col("count") <= BUCKET), radius)
    hot = scratch(rows.where(F.col("count") > BUCKET).select("k", "m", "fp"), "hot")
    inner = F
    for v, m in enumerate(outer):
        free = [b for b in every if not m >> b & 1]
        again = [
            F.struct(
                F.lit((v + 1) * 1000 + w).cast("long").alias("k2"),
                F.col("fp").bitwiseAND(F.lit(_signed(m | x))).alias("m2"),
            )
            for w, x in enumerate(masks(free, radius))
        ]
        inner = inner.when(F.col("k") == v, F.array(*again))
    split = hot.select("fp", F.inline(inner)).select(F.col("k2").alias("k"), F.col("m2").alias("m"), "fp")
    return found.union(_bucketed(split, radius))


def _judged(docs: DataFrame, radius: int, shingle: int, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, fp, root (the smallest linked fingerprint) and component_id of every row."""
    with arrow_rows(docs.sparkSession, _ROWS):
        rows = scratch(fingerprints(docs, shingle), "fingerprints")
    classes = scratch(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    roots = components(links(classes.select("fp"), scratch, radius), scratch)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = scratch(rooted.select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    lows = scratch(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    named = scratch(rooted.join(lows, "root").select("fp", "root", "component_id"), "named")
    return rows.join(named, "fp")


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, scratch: Scratch | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id.

    Fingerprints at ``radius`` or fewer differing bits link; component_id is the
    smallest doc_id reachable. A null text is an empty one: fingerprint zero, linked
    like any other. Rows with a null doc_id take part, but never name a component;
    repeated doc_ids keep a row each. No rows give no rows; other columns are ignored.
    Copies meet as one fingerprint before any bucket is formed.
    """
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _judged(docs, radius, shingle, scratch).select("doc_id", hexed, "component_id")


def representatives(
    docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, scratch: Scratch | None = None
) -> DataFrame:
    """``docs`` less all but one row of each component, columns as they are.

    The row of the smallest doc_id stays, null last; of rows with that doc_id, the one
    with the smallest text hash; of rows alike in both, any one.
    """
    own = scratch is None
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    judged = scratch(_judged(docs, radius, shingle, scratch), "judged")
    keys = judged.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash", "rows")).alias("first")
    kept = scratch(keys.groupBy("root").agg(first).select("first.doc_id", "first.text_hash", "first.rows"), "kept")
    if own:
        scratch.keep_only(kept)
    rows = packed(docs).join(kept, same_document())
    # few rows are alike in both; only they are dealt once more
    again = rows.where("rows > 1").dropDuplicates(["id", "hash"])
    return rows.where("rows = 1").unionByName(again).select("row.*")
