"""Embedding near-duplicates: an exact metric range join.

Unit vectors with a cosine of c or more lie within r = sqrt(2 - 2c) of one another.
Pivots part the vectors: each belongs to the cell of its nearest pivot. If u (cell i)
and v (cell j) are within r, the triangle inequality gives
d(v, i) <= d(v, u) + d(u, i) <= r + d(u, j) <= 2r + d(v, j). A vector is therefore
replicated to a cell i of lower number where d(v, i) - d(v, own) <= 2r, and in
Euclidean space only where it lies within r of the border of the two cells too, that
is (d(v, i)^2 - d(v, own)^2) / (2 d(i, own)) <= r. Every pair within r meets in the
cell of the lower number, once, and cells are joined independently.

Vectors that are equal are one class with a count, so copies never multiply. A cell
beyond ``CHUNK`` bytes is dealt into chunks, and pairs of chunks are joined apart; a
task holds two chunks at most. Inside, cosines are matrix products in double
precision; those near the bound are added up again in a fixed order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, components, stars

COSINE = 0.95
CELL = 8192  # classes a cell should hold of its own
PIVOTS = 4096  # pivots at most; beyond it cells grow, and are dealt into chunks
CHUNK = 16 << 20  # bytes of vectors in a chunk
_SLACK = 1e-9  # for what rounding does to distances
_CELLS = 1 << 22  # cosines held at once


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, width)


def _units(m: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _cells(pivots: np.ndarray, radius: float):
    """Rows (cell, own, cls, n, vec): a class in its own cell and where it is replicated."""
    between = _distances(pivots, pivots)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, 4096):
                part = whole.slice(at, 4096)
                d = _distances(_units(_matrix(part.column(2), pivots.shape[1])), pivots)
                own = d.argmin(axis=1)
                least = d[np.arange(len(d)), own][:, None]
                near = d - least <= 2 * radius + _SLACK
                gap = np.maximum(between[own], 1e-12)
                near &= (d * d - least * least) / (2 * gap) <= radius + _SLACK
                near &= np.arange(len(pivots))[None, :] <= own[:, None]
                near[np.arange(len(d)), own] = True
                row, cell = np.nonzero(near)
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(cell == own[row]), *(part.column(c).take(rows) for c in range(3))],
                    ["cell", "own", "cls", "n", "vec"],
                )

    return run


def _linked(units: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in left, place in right) at the cosine or above, a block of rows at a time."""
    step = max(1, _CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        i = left[at : at + step]
        cos = units[i] @ units[right].T
        x, y = np.nonzero(cos >= cosine - 1e-11)
        close = np.flatnonzero(cos[x, y] < cosine + 1e-11)
        if len(close):
            again = np.array([np.sum(units[i[a]] * units[right[b]]) for a, b in zip(x[close], y[close])])
            out = np.ones(len(x), bool)
            out[close] = again >= cosine
            x, y = x[out], y[out]
        yield i[x], right[y]


def _join(cosine: float, width: int):
    """Links among two chunks of a cell: counts (a, links, a) and stars (a, 0, b).

    A pair is the business of a cell that owns one of the two, so vectors that are both
    replicas are not compared.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        first, second = key[1].as_py(), key[2].as_py()
        cls, n, own, chunk = (rows.column(c).to_numpy() for c in ("cls", "n", "own", "chunk"))
        units = _units(_matrix(rows.column("vec").combine_chunks(), width))
        links = np.zeros(len(cls))
        one, two = chunk == first, chunk == second
        mine, theirs = np.flatnonzero(own & one), np.flatnonzero(~own & one)
        if first == second:
            jobs = [(mine, mine, False), (mine, theirs, True)]
        else:
            jobs = [(mine, np.flatnonzero(two), True), (theirs, np.flatnonzero(own & two), True)]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for left, right, both in jobs:
            for i, j in _linked(units, left, right, cosine) if len(left) and len(right) else ():
                if not both:  # all of them face each other: every pair comes twice, and each with itself
                    i, j = i[i != j], j[i != j]
                links += np.bincount(i, n[j], len(cls))
                if both:
                    links += np.bincount(j, n[i], len(cls))
                x, y = stars(cls[i], cls[j])
                a.append(x)
                b.append(y)
        x, y = stars(np.concatenate(a), np.concatenate(b))
        some = links > 0
        counts = np.rint(links[some]).astype(np.int64)
        return pa.table(
            {
                "a": np.concatenate([cls[some], x]),
                "links": np.concatenate([counts, np.zeros(len(x), np.int64)]),
                "b": np.concatenate([cls[some], y]),
            }
        )

    return run


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, scratch: Scratch | None = None
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the other rows linked directly, copies included; component_id is the
    smallest vec_id reachable. A vector that is null, empty, zero, or holds a null or
    non-finite component links with nothing and is its own component; so do vectors of
    different lengths. A row with a null vec_id is linked and counted, but names no
    component. Repeated vec_ids keep a row each; no rows give no rows; other columns
    are ignored.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "vectors")
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # single precision travels as it is
    rows = vectors.select("vec_id", F.col("embedding").cast(kind).alias("vec"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    good = F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    classes = rows.where("good").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"))
    classes = scratch(classes.withColumn("cls", F.xxhash64("vec")), "classes")
    sizes = classes.groupBy(F.size("vec").alias("width")).count().collect()  # one row per vector length
    radius = float(np.sqrt(2.0 - 2.0 * cosine))
    found = None
    for width, count in sizes:
        some = classes.where(F.size("vec") == width).select("cls", "n", "vec")
        # a bounded sample fixed by a hash; any pivots give the same links
        picked = some.orderBy("cls").limit(max(1, min(PIVOTS, count // CELL))).select("vec").collect()
        pivots = _units(np.array([r.vec for r in picked]))
        schema = f"cell int, own boolean, cls long, n long, vec {kind}"
        placed = scratch(some.mapInArrow(_cells(pivots, radius), schema), "cells")
        each = max(1, CHUNK // (8 * width))
        chunks = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / each).cast("int").alias("chunks"))
        placed = placed.join(F.broadcast(scratch(chunks, "chunks")), "cell")  # PIVOTS rows at most
        placed = placed.withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("chunks")).cast("int"))
        # each chunk meets itself and every other one once
        with_all = F.transform(
            F.sequence(F.lit(0), F.col("chunks") - 1),
            lambda c: F.struct(F.least(c, F.col("chunk")).alias("first"), F.greatest(c, F.col("chunk")).alias("second")),
        )
        dealt = placed.select("cell", "own", "cls", "n", "vec", "chunk", F.inline(with_all))
        joined = dealt.groupBy("cell", "first", "second").applyInArrow(_join(cosine, width), "a long, links long, b long")
        found = joined if found is None else found.union(joined)
    empty = spark.createDataFrame([], "a long, links long, b long")
    found = scratch(empty if found is None else found, "found")
    counts = found.where("links > 0").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    roots = components(found.where("links = 0").select("a", "b"), scratch)
    named = classes.select("cls", "n", "low").join(counts, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = scratch(named.select("cls", "n", "low", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cls").alias("root")), "named")
    lows = scratch(named.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    named = scratch(named.join(lows, "root").select("cls", (F.col("n") - 1 + F.col("links")).alias("n_links"), "component_id"), "rooted")
    linked = rows.withColumn("cls", F.when(F.col("good"), F.xxhash64("vec"))).select("vec_id", "cls").join(named, "cls", "left")
    alone = F.col("cls").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    out = linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
