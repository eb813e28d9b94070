"""Hard negatives by zone maps over Hilbert-ordered blocks.

Vectors of integers are written as Parquet blocks: rows of one label, in the order of
their places on a Hilbert curve, a few hundred a block, with the smallest and largest
component of the block in every dimension (its zone map). For an anchor a and a block,
interval arithmetic bounds every score of the block,

    sum min(a_i lo_i, a_i hi_i)  <=  a . v  <=  sum max(a_i lo_i, a_i hi_i),

so a block is read for an anchor only if these bounds meet one of its windows of scores.

- Positives: blocks of the anchor's label, from the score on that its own block, whose
  rows lie next to it on the curve, already gives.
- Negatives: blocks of other labels whose bounds meet the window of a positive. The block
  with the highest bound within the window is read first; its scores raise the lower end
  for all others.

Anchors go in groups, and the bounds of a group against a chunk of zone maps are two
matrix products. Only (group, block) pairs that are needed are joined with the blocks'
rows. Within a block rows are in the order of their ids, so that the first of equal
scores is that of the smallest id, and a task hands on the best few of a window only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.llm.common import Scratch

SCALE = 256  # components are floor(SCALE * x)
BLOCK = 256  # rows of a block
GROUP = 512  # anchors of a group
CHUNK = 512  # zone maps of a chunk
BITS = 4  # of a component on the curve
LANES = 64  # parts in which chunks of zone maps are dealt to all groups
_LOW, _HIGH = -(1 << 62), 1 << 62

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_NUMBERS, _TEXTS = pa.list_(pa.int64()), pa.list_(pa.string())
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("dims", pa.int32()), ("label", pa.string()), ("n", pa.int32()), ("ids", _NUMBERS)]
    + [("vecs", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary()), ("anchors", pa.list_(pa.int32()))]
)
_WINDOW = pa.struct([("a", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64())])  # an anchor's scores from lo to hi
_GROUPS = pa.schema(
    [("group", pa.int64()), ("dims", pa.int32()), ("ids", _NUMBERS), ("labels", _TEXTS), ("own", _NUMBERS)]
    + [("at", pa.list_(pa.int32())), ("vecs", pa.binary()), ("windows", pa.list_(_WINDOW))]
)
_ZONES = pa.schema(
    [("lane", pa.int32()), ("dims", pa.int32()), ("blocks", _NUMBERS), ("labels", _TEXTS), ("lo", pa.binary()), ("hi", pa.binary())]
)


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places of the rows of ``cells`` (unsigned, below 2^bits) on a Hilbert curve, as
    byte strings in the curve's order; the axes are turned level by level, then their
    bits interleaved."""
    x = cells.astype(np.uint32)
    rows, dims = x.shape
    if not dims:
        return [b""] * rows
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(dims):
            high = (x[:, i] & np.uint32(q)) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low).astype(np.uint32)
            x[:, 0] ^= np.where(high, low, swap).astype(np.uint32)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(rows, np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[:, -1] & np.uint32(q), np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn[:, None]
    levels = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    planes = ((x[:, None, :] >> levels[None, :, None]) & 1).astype(np.uint8)
    return [r.tobytes() for r in np.packbits(planes.reshape(rows, -1), axis=1)]


def _kind(top: int) -> str:
    """The smallest integers that hold components up to ``top`` in magnitude."""
    return next(k for k, most in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 63)) if top < most)


def _work(top: int, dims: int) -> type:
    """Numbers in which inner products are exact: doubles below 2^53, else 64-bit integers."""
    most = dims * top * top
    if most >= 1 << 55:
        raise ValueError("inner products of these components, times 100, do not fit 64-bit integers")
    return np.float64 if most < 1 << 53 else np.int64


def _matrix(data: bytes, kind: str, dims: int, rows: int, work: type) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, dims).astype(work)


def _keyed(top: int):
    """Rows with their place on the curve and their components packed."""
    kind = _kind(top)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            q = part.column("q")
            sizes = np.diff(q.offsets.to_numpy())
            flat = q.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            keys, vecs = [b""] * len(sizes), [b""] * len(sizes)
            for dims in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == dims)
                m = flat[ends[rows][:, None] + np.arange(dims)]
                cells = ((m + top).astype(np.float64) * (1 << BITS) / (2 * top + 1)).astype(np.uint32)
                for i, key, vec in zip(rows.tolist(), hilbert_keys(np.minimum(cells, (1 << BITS) - 1), BITS), m.astype(kind)):
                    keys[i], vecs[i] = key, vec.tobytes()
            columns = [part.column(c) for c in ("vec_id", "label", "anchor", "nth")]
            columns += [pa.array(sizes.astype(np.int32)), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "anchor", "nth", "dims", "key", "vec"])

    return run


def _blocks(top: int, size: int):
    """Blocks of ``size`` rows at most, of one label and length, from sorted rows."""
    kind = _kind(top)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, held, of = TaskContext.get().partitionId() << 32, 0, [], None

        def block() -> dict:
            nonlocal number
            held.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0))
            dims, label = of
            vecs = b"".join(r["vec"] for r in held)
            m = np.frombuffer(vecs, kind).reshape(len(held), dims)
            made = {"block": first + number, "dims": dims, "label": label, "n": len(held), "ids": [r["vec_id"] for r in held], "vecs": vecs,
                    "lo": m.min(axis=0).tobytes(), "hi": m.max(axis=0).tobytes(), "anchors": [i for i, r in enumerate(held) if r["anchor"]]}
            number += 1
            held.clear()
            return made

        for part in parts:
            ready = []
            for row in part.to_pylist():
                if held and (of != (row["dims"], row["label"]) or len(held) >= size):
                    ready.append(block())
                of = row["dims"], row["label"]
                held.append(row)
            if ready:
                yield pa.RecordBatch.from_pylist(ready, _BLOCKS)
        if held:
            yield pa.RecordBatch.from_pylist([block()], _BLOCKS)

    return run


def _zones():
    """Zone maps of many blocks in a row, dealt to lanes."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId(), []

        def chunk() -> pa.RecordBatch:
            nonlocal number
            made = {"lane": number % LANES, "dims": held[0]["dims"], "blocks": [r["block"] for r in held], "labels": [r["label"] for r in held],
                    "lo": b"".join(r["lo"] for r in held), "hi": b"".join(r["hi"] for r in held)}
            number += 1
            held.clear()
            return pa.RecordBatch.from_pylist([made], _ZONES)

        for part in parts:
            for row in part.to_pylist():
                if held and (held[0]["dims"] != row["dims"] or len(held) >= CHUNK):
                    yield chunk()
                held.append(row)
        if held:
            yield chunk()

    return run


def _packed_anchors(top: int, positives: int):
    """Groups of anchors, each with the window of its positives: from the score on that
    its own block gives, if that holds enough others."""
    kind = _kind(top)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, held, of = TaskContext.get().partitionId() << 32, 0, [], None

        def group() -> pa.RecordBatch:
            nonlocal number
            names = ("ids", "labels", "own", "at")
            made = {name: [r[i] for r in held] for i, name in enumerate(names)}
            made |= {"group": first + number, "dims": of, "vecs": b"".join(r[4] for r in held)}
            made["windows"] = [{"a": i, "lo": r[5], "hi": _HIGH} for i, r in enumerate(held)]
            number += 1
            held.clear()
            return pa.RecordBatch.from_pylist([made], _GROUPS)

        for part in parts:
            for row in part.to_pylist():
                m = _matrix(row["vecs"], kind, row["dims"], row["n"], _work(top, row["dims"]))
                for at in row["anchors"]:
                    if held and (of != row["dims"] or len(held) >= GROUP):
                        yield group()
                    of = row["dims"]
                    others = np.delete(m @ m[at], at)
                    low = int(np.partition(others, -positives)[-positives]) if len(others) >= positives else _LOW
                    vec = m[at].astype(kind).tobytes()
                    held.append((row["ids"][at], row["label"], row["block"], at, vec, low))
        if held:
            yield group()

    return run


def _choose(top: int, same: bool, best: bool):
    """Blocks whose bounds meet the windows of a group: (group, block, bits of the windows),
    or with ``best`` (group, window, bound, block): only the one with the highest bound."""
    kind = _kind(top)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                if not row["windows"]:
                    continue
                dims, blocks = row["dims"], np.array(row["blocks"])
                work = _work(top, dims)
                a = _matrix(row["vecs"], kind, dims, len(row["ids"]), work)
                lo, hi = (_matrix(row[c], kind, dims, len(blocks), work) for c in ("lo", "hi"))
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                most, least = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
                alike = np.array(row["labels"], object)[:, None] == np.array(row["zone_labels"], object)[None, :]
                window = {c: np.array([w[c] for w in row["windows"]]) for c in ("a", "lo", "hi")}
                who = window["a"]
                meets = (alike if same else ~alike)[who]
                meets &= (most[who] >= window["lo"][:, None]) & (least[who] <= window["hi"][:, None])
                if best:
                    bound = np.where(meets, np.minimum(most[who], window["hi"][:, None].astype(work)), -np.inf)
                    top_one = bound.argmax(axis=1)
                    w = np.flatnonzero(meets.any(axis=1))
                    bounds = bound[w, top_one[w]].astype(np.int64)
                    columns = [pa.array(np.full(len(w), row["group"])), pa.array(w.astype(np.int32)), pa.array(bounds), pa.array(blocks[top_one[w]])]
                    yield pa.RecordBatch.from_arrays(columns, ["group", "w", "bound", "block"])
                    continue
                z = np.flatnonzero(meets.any(axis=0))
                bits = [b.tobytes() for b in np.packbits(meets[:, z].T, axis=1)]
                columns = [pa.array(np.full(len(z), row["group"])), pa.array(blocks[z]), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["group", "block", "bits"])

    return run


def _read(top: int, k: int, by_bits: bool):
    """The best ``k`` rows of a block for each window of a group that must read it."""
    kind = _kind(top)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                dims, n, count = row["dims"], row["n"], len(row["windows"])
                work = _work(top, dims)
                bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=count) if by_bits else None
                ws = np.flatnonzero(bits) if by_bits else np.array(row["ws"])
                who = np.array([row["windows"][w]["a"] for w in ws])
                low, high = (np.array([row["windows"][w][c] for w in ws])[:, None] for c in ("lo", "hi"))
                used, which = np.unique(who, return_inverse=True)
                a = _matrix(row["vecs"], kind, dims, len(row["ids"]), work)[used]
                scores = (a @ _matrix(row["rows"], kind, dims, n, work).T)[which].astype(np.int64)
                scores[(scores < low) | (scores > high)] = _LOW - 1
                own, at = np.array(row["own"])[who], np.array(row["at"])[who]
                mine = np.flatnonzero(own == row["block"])
                scores[mine, at[mine]] = _LOW - 1
                found = []
                for _ in range(min(k, n)):  # the first of equal scores has the smallest id
                    place = scores.argmax(axis=1)
                    score = scores[np.arange(len(ws)), place]
                    some = np.flatnonzero(score >= _LOW)
                    if not len(some):
                        break
                    found.append((ws[some], score[some], place[some]))
                    scores[some, place[some]] = _LOW - 1
                if found:
                    w, score, place = (np.concatenate(x) for x in zip(*found))
                    columns = [pa.array(np.full(len(w), row["group"])), pa.array(w.astype(np.int32)), pa.array(score)]
                    columns.append(pa.array(row["row_ids"], pa.int64()).take(pa.array(place)))
                    yield pa.RecordBatch.from_arrays(columns, ["group", "w", "score", "id"])

    return run


class _Mine:
    """The written blocks and zone maps of one call."""

    def __init__(self, scratch: Scratch, blocks: DataFrame, top: int):
        self._scratch, self._blocks, self._top = scratch, blocks, top
        zones = blocks.select("block", "dims", "label", "lo", "hi").mapInArrow(_zones(), from_arrow_schema(_ZONES))
        self._zones = scratch(zones, "zones").select("lane", "dims", "blocks", F.col("labels").alias("zone_labels"), "lo", "hi")

    def _chosen(self, groups: DataFrame, same: bool, best: bool) -> DataFrame:
        lanes = groups.drop("own", "at").withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
        schema = "group long, w int, bound long, block long" if best else "group long, block long, bits binary"
        met = lanes.join(self._zones, ["lane", "dims"]).mapInArrow(_choose(self._top, same, best), schema)
        if best:
            first = met.groupBy("group", "w").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
            met = first.groupBy("group", "block").agg(F.collect_list("w").alias("ws"))  # at most the windows of a group
        return self._scratch(met, "best" if best else "chosen")

    def _scores(self, groups: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
        rows = self._blocks.select("block", "n", F.col("ids").alias("row_ids"), F.col("vecs").alias("rows"))
        facing = chosen.join(rows, "block").join(groups.drop("labels"), "group")
        return facing.mapInArrow(_read(self._top, k, "bits" in chosen.columns), "group long, w int, score long, id long")

    def best(self, groups: DataFrame, same: bool, k: int, probe: bool) -> DataFrame:
        """(group, w, rank, score, id): the first ``k`` rows of every window."""
        if probe:
            groups = self._scratch(self._raised(groups, same, k), "groups")
        found = self._scores(groups, self._chosen(groups, same, False), k)
        order = W.partitionBy("group", "w").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return self._scratch(ranked, "found")

    def _raised(self, groups: DataFrame, same: bool, k: int) -> DataFrame:
        """Groups whose windows start at the k-th score of the block read first."""
        found = self._scores(groups, self._chosen(groups, same, True), k)
        full = found.groupBy("group", "w").agg(F.min("score").alias("lo"), F.count("score").alias("n")).where(F.col("n") >= k)
        lows = full.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("w", "lo"))).alias("lows"))
        raised = F.transform(
            "windows",
            lambda w, i: F.struct(w["a"].alias("a"), F.coalesce(F.col("lows")[i], w["lo"]).alias("lo"), w["hi"].alias("hi")),
        )
        return groups.join(lows, "group", "left").withColumn("windows", raised).drop("lows")


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block: int = BLOCK,
    scratch: Scratch | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding. Components become floor(256 x); a row's
    score is its inner product with the anchor. The rows for which ``anchor`` holds are
    anchors; their positives are the first other rows of their label, by score, then by
    smaller vec_id. For each positive the first rows of other labels follow whose score
    is between ``low`` and ``high`` per cent of the positive's.

    Rows without a label or a vector, or with a null or non-finite component, take no
    part. Repeated rows count each, and an anchor leaves out only its own row. A null
    vec_id is no anchor unless ``anchor`` says so, and comes after all others among equal
    scores. Vectors of different lengths do not meet; empty ones score 0. An anchor
    without a positive, a positive without a negative, and a table without rows give no
    row. Tables whose scores might go beyond 2^55 are refused with an error. Other columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "negatives")
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False)))
    most = good.agg(F.max(F.array_max(F.transform(x, lambda v: F.abs(v * SCALE)))).alias("m"), F.count(F.lit(1)).alias("n")).first()
    if not most["n"]:
        return spark.createDataFrame([], RESULT)
    if (most["m"] or 0) >= 1 << 30:
        raise ValueError("components are too large for 64-bit scores")
    top = int(most["m"] or 0) + 1

    rows = good.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.monotonically_increasing_id().alias("nth"),
        F.transform(x, lambda v: F.floor(v * SCALE)).alias("q"),
    )
    keyed = rows.mapInArrow(_keyed(top), "vec_id long, label string, anchor boolean, nth long, dims int, key binary, vec binary")
    # copies of one vector are dealt by their ids, and copies of rows by their place
    order = ["dims", "label", "key", "vec_id", "nth"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    curve = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = scratch(curve.mapInArrow(_blocks(top, block), from_arrow_schema(_BLOCKS)), "blocks")

    mine = _Mine(scratch, blocks, top)
    some = blocks.where(F.size("anchors") > 0)
    groups = scratch(some.mapInArrow(_packed_anchors(top, positives), from_arrow_schema(_GROUPS)), "anchors")
    near = mine.best(groups, True, positives, probe=False)

    # every positive opens a window, in whole numbers: pmod makes the division round down
    scored = near.select("group", F.struct("w", "rank", "score", "id").alias("p"))
    listed = scored.groupBy("group").agg(F.sort_array(F.collect_list("p")).alias("p"))  # some anchors' few positives

    def hundredth(n: Column) -> Column:
        return F.call_function("div", n - F.pmod(n, F.lit(100)), F.lit(100))

    opened = F.transform(
        "p",
        lambda p: F.struct(
            p["w"].alias("a"), (-hundredth(p["score"] * -low)).alias("lo"), hundredth(p["score"] * high).alias("hi")
        ),
    )
    facing = scratch(groups.drop("windows").join(listed, "group").withColumn("windows", opened), "positives")
    far = mine.best(facing.drop("p"), False, negatives, probe=True)
    named = facing.select("group", "ids", F.posexplode("p").alias("w", "p"))
    found = far.withColumnRenamed("score", "negative_score").join(named, ["group", "w"])
    return found.select(
        F.get("ids", F.col("p.w")).alias("anchor_id"),
        F.col("p.id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        "negative_score",
    )
