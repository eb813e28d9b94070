"""Suffix-array dedup: removes bytes covered by long strings that start elsewhere too.

Equal windows of ``WINDOW`` bytes must meet in one shard. Each window has an anchor,
the least hash among its runs of ``RUN`` bytes (the last one of equals), which depends
on the window alone; windows that follow one another share an anchor, and the bytes
they span make one stretch. Stretches are dealt by anchor:

1. An anchor seen in one place only has no repeated window; most of a corpus ends here.
2. Where all stretches of an anchor are the same bytes, all their windows repeat.
3. Other anchors have their distinct stretches put into shards by anchor, and external
   induced sorting (``induced.py``) of a shard's suffixes, with common prefixes carried
   along, marks the windows that occur again.

Stretches of an anchor with more than ``SHARD`` bytes are cut by content first: equal
windows have their anchor at the same offset, so those of a block of offsets agree in
the bytes that all windows of the block have around the anchor. Pieces are dealt by a
digest of these; blocks of groups still too large are narrowed until they are single
windows, which need no sorting. A piece alone in its group repeats nothing and is left.

Rows with equal texts are one text with a count and stretches with equal bytes travel
once, so groups of copies stay small everywhere. Shards are sized in bytes from the
counted stretches and pieces, and no group in them is larger than ``SHARD``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, arrow_rows
from tidemark.llm.induced import repeated

WINDOW = 200
RUN = 32
SHARD = 2 << 20  # bytes of stretches
BLOCKS = (64, 16, 4, 1)  # offsets of the anchor in a block, step by step
_PIECE = 1 << 18  # bytes hashed at once
_SEEN = 1 << 16  # texts a task remembers to have looked at
_ROWS = 512  # rows of whole texts handed to a worker at once
_CUT = "h long, digest long, n long, bytes binary, off long, g binary"


def _byte_hashes() -> np.ndarray:
    """A fixed 64-bit number for each byte value."""
    x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_BYTES = _byte_hashes()


def _run_hashes(e: np.ndarray, run: int) -> np.ndarray:
    """A hash of the ``run`` bytes (a power of two) from each position."""
    h, factor, span = _BYTES[e], 0xD6E8FEB86659FD93, 1
    while span < run:
        h = h[:-span] * np.uint64(factor) + h[span:]
        factor, span = factor * factor % (1 << 64), 2 * span
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def _least(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least hash of every ``width`` in a row, and its place; of equals the last."""
    place, span = np.arange(len(h), dtype=np.int32), 1
    while span < width:
        by = min(span, width - span)
        later = h[by:] <= h[:-by]
        h, place = np.where(later, h[by:], h[:-by]), np.where(later, place[by:], place[:-by])
        span += by
    return h, place


def stretches(texts: list[bytes], window: int = WINDOW, run: int = RUN) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, anchor, first window, windows, digest) of all stretches of the texts.

    Texts are looked at together, long ones piece by piece; a stretch may end with its
    piece, which splits its windows but loses none.
    """
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - window + 1, _PIECE):
            piece = text[at : at + _PIECE + window - 1]
            group.append((i, at, piece))
            size += len(piece)
            if size >= _PIECE:
                yield _stretched(group, window, run)
                group, size = [], 0
    if group:
        yield _stretched(group, window, run)


def _stretched(group: list[tuple[int, int, bytes]], window: int, run: int) -> tuple[np.ndarray, ...]:
    data = b"".join(x[2] for x in group)
    sizes = np.array([len(x[2]) for x in group])
    ends = np.cumsum(sizes)
    least, place = _least(_run_hashes(np.frombuffer(data, np.uint8), run), window - run + 1)
    owner = np.repeat(np.arange(len(group)), sizes)[: len(place)]
    inside = np.arange(len(place)) + window <= ends[owner]
    new = np.append(True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1])
    first = np.flatnonzero(new & inside)
    # the windows of a stretch end where the next one starts, or with the piece
    count = np.diff(np.append(first, len(place)))
    count = np.minimum(count, ends[owner[first]] - window + 1 - first)
    view = memoryview(data)
    stops = (first + count + window - 1).tolist()
    digest = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), stops)], np.uint64)
    number = np.array([x[0] for x in group])[owner[first]]
    begin = first - (ends - sizes)[owner[first]] + np.array([x[1] for x in group])[owner[first]]
    return number, least[first].view(np.int64), begin, count, digest.view(np.int64)


def _anchored(docs: DataFrame, window: int, run: int) -> DataFrame:
    """(h, key, first, n, digest) of every stretch; a task looks at equal texts once."""

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part in parts:
            for at in range(0, part.num_rows, 512):
                keys, texts = [], []
                for key, text in zip(*(part.column(c).slice(at, 512).to_pylist() for c in (0, 1))):
                    if len(text) >= window and key not in seen:
                        seen.add(key)
                        keys.append(key)
                        texts.append(text)
                if len(seen) > _SEEN:
                    seen.clear()
                named = pa.array(keys, pa.binary())
                for number, h, first, n, digest in stretches(texts, window, run):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), named.take(pa.array(number)), *map(pa.array, (first, n, digest))],
                        ["h", "key", "first", "n", "digest"],
                    )

    return docs.select("key", "data").mapInArrow(scan, "h long, key binary, first long, n long, digest long")


def _sorted_out(window: int):
    """Shards of (h, digest, n, bytes, off) to the runs of repeated windows of each stretch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = [part for part in parts if part.num_rows]
        if not shard:
            return
        rows = pa.Table.from_batches(shard)
        sizes = np.array([len(x) for x in rows.column(3).to_pylist()])
        text = np.zeros(int(sizes.sum()) + len(sizes), np.uint16)  # zero ends a stretch
        starts = np.cumsum(sizes + 1) - sizes - 1
        for at, piece in zip(starts.tolist(), rows.column(3)):
            e = np.frombuffer(piece.as_py(), np.uint8)
            text[at : at + len(e)] = e
            text[at : at + len(e)] += 1
        again = repeated(text, window)
        again[text == 0] = False
        for at, n, size in zip(starts.tolist(), rows.column(2).to_pylist(), sizes.tolist()):
            again[at + n : at + size] = False  # no windows of the stretch start there
        edge = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
        low, high = edge[::2], edge[1::2]
        owner = np.searchsorted(starts, low, side="right") - 1
        named = rows.select([0, 1]).take(pa.array(owner)).combine_chunks()
        begin = starts[owner] - rows.column(4).to_numpy()[owner]
        columns = [*(named.column(i).combine_chunks() for i in range(2)), pa.array(low - begin), pa.array(high - begin - 1)]
        yield pa.RecordBatch.from_arrays(columns, ["h", "digest", "a", "b"])

    return run


def _cut(window: int, run: int, width: int):
    """Pieces (h, digest, n, bytes, off, g) to pieces of blocks of ``width`` anchor offsets.

    ``off`` is the piece's first window in its stretch; ``g`` is the digest of a block
    and of the bytes that its windows have in common. Single windows carry no bytes.
    """

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (whole.slice(at, _ROWS) for whole in parts for at in range(0, whole.num_rows, _ROWS)):
            h, digest, n, data, off = (part.column(i) for i in range(5))
            data = data.to_pylist()
            sizes = np.array([len(x) for x in data])
            starts = np.cumsum(sizes) - sizes
            found = _run_hashes(np.frombuffer(b"".join(data), np.uint8), run).view(np.int64)
            owner = np.repeat(np.arange(len(data)), sizes)[: len(found)]
            hit = np.flatnonzero((found == h.to_numpy()[owner]) & (np.arange(len(found)) - starts[owner] <= window - run))
            place = np.zeros(len(data), np.int64)
            place[owner[hit]] = hit - starts[owner[hit]]  # of equals the last, as in a window
            row, count, piece, first, group = [], [], [], [], []
            for i, (x, at, windows, begin) in enumerate(zip(data, place.tolist(), n.to_pylist(), off.to_pylist())):
                a = 0
                while a < windows:
                    k = (at - a) // width
                    last = at - k * width  # the block's last window, first of its common bytes
                    b = min(windows, last + 1)
                    row.append(i)
                    count.append(b - a)
                    piece.append(x[a : b - 1 + window] if width > 1 else b"")
                    first.append(begin + a)
                    group.append(xxhash.xxh3_128_digest(x[last : last - width + 1 + window], seed=k))
                    a = b
            take = pa.array(row, pa.int64())
            columns = [h.take(take), digest.take(take), pa.array(count, pa.int64()), pa.array(piece, pa.binary()),
                       pa.array(first, pa.int64()), pa.array(group, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["h", "digest", "n", "bytes", "off", "g"])

    return cut


def _narrowed(rows: DataFrame, scratch: Scratch, window: int, run: int) -> tuple[list[tuple[DataFrame, int]], DataFrame | None]:
    """Pieces of hot anchors as frames of groups of at most ``SHARD`` bytes, with their bytes; and marks of single windows."""
    small: list[tuple[DataFrame, int]] = []
    for width in BLOCKS:
        rows = scratch(rows.mapInArrow(_cut(window, run, width), _CUT), f"blocks{width}")
        groups = rows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("n") + window).alias("size"))
        fits = F.col("size") <= SHARD
        groups, seen = scratch.counted(
            groups.where("rows > 1").drop("rows"), f"groups{width}",
            F.sum(F.when(fits, F.col("size"))).alias("fitting"), F.count(F.when(~fits, 1)).alias("large"),
        )
        large = groups.where(~fits).select("h", "g")  # staged: Spark broadcasts it if it is small
        rest = rows.join(large, ["h", "g"], "left_anti").join(groups.where(fits).select("h", "g"), ["h", "g"])
        rows = rows.join(large, ["h", "g"], "left_semi").select(rows.columns)
        if width == 1:
            one = rows.select("h", "digest", "off").union(rest.select("h", "digest", "off"))
            order = F.row_number().over(W.partitionBy("h", "digest").orderBy("off"))
            one = one.withColumn("run", F.col("off") - order)
            return small, one.groupBy("h", "digest", "run").agg(F.min("off").alias("a"), F.max("off").alias("b")).drop("run")
        small.append((rest.select(rows.columns), seen["fitting"] or 0))
        if not seen["large"]:
            break
    return small, None


def _places(docs: DataFrame, scratch: Scratch, window: int, run: int) -> DataFrame:
    """(key, a, b): runs of first to last start of a repeated window, in texts with equal bytes once."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _anchored(docs, window, run).repartition(n, "h")
    # the groups and the join below read the same columns, so they share one shuffle
    place, piece = F.struct("key", "first"), F.struct("digest", "n")
    groups = dealt.groupBy("h").agg(
        F.min(place).alias("p"), F.max(place).alias("q"), F.min(piece).alias("d"), F.max(piece).alias("e")
    )
    groups = groups.where("p <> q").select("h", (F.col("d") != F.col("e")).alias("mixed"))
    found = scratch(dealt.join(groups, "h"), "found")
    digests = found.groupBy("h", "digest", "mixed").agg(F.min(place).alias("p"), F.max(place).alias("q"), F.first("n").alias("n"))
    digests = scratch(digests.withColumn("again", F.col("p") != F.col("q")), "digests")
    whole = digests.where("again").select("h", "digest", F.lit(0).cast("long").alias("a"), (F.col("n") - 1).alias("b"))
    mixed = digests.where("mixed")
    anchors = mixed.groupBy("h").agg(F.sum(F.col("n") + window).alias("size"))
    fits = F.col("size") <= SHARD
    anchors, seen = scratch.counted(
        anchors, "anchors", F.sum(F.when(fits, F.col("size"))).alias("fitting"), F.count(F.when(~fits, 1)).alias("large")
    )
    hot = anchors.where(~fits).select("h")  # staged: Spark broadcasts it if it is small
    sought = mixed.select(F.col("p.key").alias("key"), F.struct("h", "digest", "n", F.col("p.first").alias("first")).alias("s"))
    sought = scratch(sought.groupBy("key").agg(F.collect_list("s").alias("s")), "sought")
    texts = docs.select("key", "data").dropDuplicates(["key"]).join(sought, "key")
    cut = F.transform(
        "s",
        lambda s: F.struct(
            s["h"].alias("h"),
            s["digest"].alias("digest"),
            s["n"].alias("n"),
            F.substring(F.col("data"), (s["first"] + 1).cast("int"), (s["n"] + window - 1).cast("int")).alias("bytes"),
        ),
    )
    pieces = texts.select(F.inline(cut)).select("*", F.lit(0).cast("long").alias("off"), F.lit(b"").alias("g"))
    small, single = [(pieces, seen["fitting"] or 0)], None
    if seen["large"]:
        pieces = scratch(pieces, "pieces")
        more, single = _narrowed(pieces.join(hot, "h", "left_semi").select(pieces.columns), scratch, window, run)
        small = [(pieces.join(hot, "h", "left_anti").select(pieces.columns), small[0][1]), *more]
    shards = max(1, -(-sum(size for _, size in small) // SHARD))
    pieces = reduce(DataFrame.union, [p for p, _ in small]).repartition(int(shards), "h", "g")
    pieces = pieces.select("h", "digest", "n", "bytes", "off")
    some = scratch(pieces.mapInArrow(_sorted_out(window), "h long, digest long, a long, b long"), "sorted")
    marks = whole.union(some) if single is None else whole.union(some).union(single)
    marks = scratch(marks, "marks")
    rows = found.select("h", "digest", "key", "first").join(marks, ["h", "digest"])
    return rows.select("key", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))


def _removed(window: int, carry: int):
    """Rows (others.., data, runs, all) to (others.., n_bytes, n_removed, n_spans, kept)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (whole.slice(at, _ROWS) for whole in parts for at in range(0, whole.num_rows, _ROWS)):
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for data, runs, whole in zip(*(part.column(carry + i).to_pylist() for i in range(3))):
                if whole:
                    runs = [{"a": 0, "b": len(data) - window}]
                pieces, at, spans, gone = [], 0, 0, 0
                for r in sorted(((r["a"], r["b"] + window) for r in runs or ()), key=lambda r: r[0]):
                    if r[0] > at or not spans:  # runs that touch are one span
                        pieces.append(data[at : r[0]])
                        spans, at = spans + 1, r[0]
                    gone += max(0, r[1] - at)
                    at = max(at, r[1])
                pieces.append(data[at:])
                n_bytes.append(len(data))
                n_removed.append(gone)
                n_spans.append(spans)
                kept.append(b"".join(pieces))
            columns = [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
            kept = pa.array(kept, pa.binary())
            names = [*part.schema.names[:carry], "n_bytes", "n_removed", "n_spans", "kept"]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(carry)), *columns, kept], names)

    return run


def without_repeats(
    docs: DataFrame, window: int = WINDOW, run: int = RUN, scratch: Scratch | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Every byte inside a ``window``-byte string that also starts elsewhere, in the same
    document too, is removed; strings are judged on the input. A null text is an empty
    one; texts below ``window`` bytes lose nothing. Repeated rows are documents of their
    own, so all of their long texts go. Null doc_ids are no matter; other columns are
    ignored; no rows give no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "suffixes")
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    rows = docs.select("doc_id", data.alias("data")).withColumn("key", F.unhex(F.md5("data")))
    keys = rows.select("key", F.octet_length("data").alias("size")).where(F.col("size") >= window)
    copies = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = copies.select("key", F.lit(True).alias("whole"))
    with arrow_rows(docs.sparkSession, _ROWS):
        runs = _places(rows, scratch, window, run).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("runs"))
        marks = scratch(runs.join(copies, "key", "full"), "removals")
    joined = rows.join(marks, "key", "left").select("doc_id", "data", "runs", F.coalesce("whole", F.lit(False)).alias("whole"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(_removed(window, 1), schema)
