"""Periodic runs of words, by block convolution.

A run is a stretch of words with smallest period q and a length of at least
max(24, 3q) that no neighbouring word extends. At scale B = 8, 16, 32 ... periods from
B to 2B - 1 are looked for (and those below 8 at the first scale). A text is cut into
blocks of B words. A run of such a period is so long that it holds a whole block
together with the block's copy q words on, so the block occurs again, without a
mismatch, at distance q within the window that follows it.

Those occurrences are read from sums of squared differences between the words' numbers,

    sum (x[i] - x[i + d])^2 = sum x[i]^2 + sum x[i + d]^2 - 2 sum x[i] x[i + d],

zero where the block occurs at distance d. The last sum is a convolution, done for all d
at once by number-theoretic transforms. They are exact: the sums are taken modulo as many
primes as make the largest possible sum smaller than the primes' product, so a sum is
zero if, and only if, it is zero modulo each. Each distance seeds an extension to both
sides until words q apart differ.

Two exact rules keep the number of seeds in proportion to the number of blocks. A block
with a word that does not come back within its window has no occurrence and is not
convolved. A block with a period p of at most B/3 lies in a run S of period p that a
smaller scale has found; a run of a longer period that holds the block goes beyond one
end of S, so only distances at which a neighbour of S matches too are seeds. All other
blocks occur a handful of times at most.

Documents are mapped one by one and nothing is shuffled: the texts of a batch are
numbered and convolved together, in slices of bounded size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 24  # words in a run at least
FIRST = 8  # words in a block of the first scale
TOGETHER = 200_000  # words of documents taken together
_CELLS = 1 << 18  # numbers transformed at once, unless one window is longer
# Primes k * 2^25 + 1 below 2^31, each with a generator of its residues.
PRIMES = ((2_013_265_921, 31), (469_762_049, 3), (167_772_161, 3))
_MOST = 25  # transforms of up to 2^25 numbers

RUN_COLUMNS = (
    "doc_id {}, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>"
)

_ROOTS: dict[tuple[int, int, bool], list[np.ndarray]] = {}


def _roots(prime: int, generator: int, size: int, inverse: bool) -> list[np.ndarray]:
    """Powers of the root of unity for each step of a transform, longest step first."""
    key = prime, size, inverse
    if key not in _ROOTS:
        root = pow(generator, (prime - 1) // size, prime)
        root = pow(root, -1, prime) if inverse else root
        powers = np.ones(max(1, size // 2), np.uint64)
        have = 1
        while have < len(powers):  # doubling: the second half is the first times root^have
            powers[have : 2 * have] = powers[:have] * np.uint64(pow(root, have, prime)) % np.uint64(prime)
            have *= 2
        steps, gap = [], 1
        while gap < size:
            steps.append(powers[::gap].copy())
            gap *= 2
        if sum(8 * k[1] for k in _ROOTS) > 64 << 20:
            _ROOTS.clear()
        _ROOTS[key] = steps
    return _ROOTS[key]


def _forward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transforms of the rows of x, in bit-reversed order; decimation in frequency."""
    rows, size = x.shape
    p = np.uint64(prime)
    for powers in _roots(prime, generator, size, False):
        half = len(powers)
        x = x.reshape(rows, -1, 2, half)
        a, b = x[:, :, 0], x[:, :, 1]
        out = np.empty_like(x)
        np.remainder(a + b, p, out=out[:, :, 0])
        np.remainder((a + (p - b)) * powers, p, out=out[:, :, 1])
        x = out
    return x.reshape(rows, size)


def _backward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Rows whose transforms, in bit-reversed order, are x; decimation in time."""
    rows, size = x.shape
    p = np.uint64(prime)
    for powers in reversed(_roots(prime, generator, size, True)):
        half = len(powers)
        x = x.reshape(rows, -1, 2, half)
        a, b = x[:, :, 0], x[:, :, 1] * powers % p
        out = np.empty_like(x)
        np.remainder(a + b, p, out=out[:, :, 0])
        np.remainder(a + (p - b), p, out=out[:, :, 1])
        x = out
    return x.reshape(rows, size) * np.uint64(pow(size, -1, prime)) % p


def occurrences(windows: np.ndarray, block: int) -> np.ndarray:
    """For each row, whether its first ``block`` numbers stand again at distances 1 to 2 * block - 1.

    ``windows`` holds 3 * block non-negative numbers a row; column d - 1 of the result
    is distance d.
    """
    rows, width = windows.shape
    size = 4 * block  # a power of two above the window, so that sums do not wrap round
    top = int(windows.max(initial=0))
    bound, primes = block * top * top, []
    for prime, generator in PRIMES:
        primes.append((prime, generator))
        bound //= prime
        if not bound:
            break
    if bound or size > 1 << _MOST:
        raise ValueError(f"{block} words of up to {top} numbers are beyond {len(PRIMES)} primes")
    same = np.ones((rows, 2 * block - 1), bool)
    for prime, generator in primes:
        p = np.uint64(prime)
        text = np.zeros((rows, size), np.uint64)
        text[:, :width] = windows % prime
        word = np.zeros((rows, size), np.uint64)
        word[:, 0] = text[:, 0]
        word[:, size - block + 1 :] = text[:, block - 1 : 0 : -1]  # turned round: a product of transforms slides it
        product = _forward(text, prime, generator) * _forward(word, prime, generator) % p
        slid = _backward(product, prime, generator)[:, 1 : 2 * block]
        squares = np.zeros((rows, width + 1), np.uint64)
        np.cumsum(text[:, :width] ** 2 % p, axis=1, out=squares[:, 1:])
        ending = squares[:, block + 1 : 3 * block] - squares[:, 1 : 2 * block]
        same &= (squares[:, block : block + 1] + ending + (p - slid) * np.uint64(2)) % p == 0
    return same


def _next_place(x: np.ndarray) -> np.ndarray:
    """For each place, how far on the same number stands next; very far if it does not."""
    order = np.argsort(x, kind="stable")
    gap = np.full(len(x), np.iinfo(np.int64).max // 2)
    again = x[order[1:]] == x[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return gap


def _reach(x: np.ndarray, at: int, distance: int, low: int, high: int) -> tuple[int, int]:
    """Places [left, right) round ``at`` that equal the place ``distance`` on, within [low, high)."""
    right, step = at, 64
    while right < high - distance:
        end = min(right + step, high - distance)
        differ = x[right:end] != x[right + distance : end + distance]
        stop = int(differ.argmax())
        if differ[stop]:
            right += stop
            break
        right, step = end, step * 2
    left, step = at, 64
    while left > low:
        begin = max(left - step, low)
        differ = (x[begin:left] != x[begin + distance : left + distance])[::-1]
        stop = int(differ.argmax())
        if differ[stop]:
            left -= stop
            break
        left, step = begin, step * 2
    return left, right


def find_runs(x: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, by start and period.

    ``x`` holds the word numbers of all documents, one after another, and ``bounds``
    where each starts, and the end.
    """
    runs: list[dict[tuple[int, int], int]] = [{} for _ in bounds[1:]]
    sizes = np.diff(bounds)
    gap = _next_place(x)
    block = FIRST
    while len(some := np.flatnonzero(sizes >= max(LEAST, 3 * block))):
        counts = sizes[some] // block
        doc = np.repeat(some, counts)
        inner = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = bounds[doc] + inner * block
        whole = at + block < bounds[doc + 1]
        farthest = np.maximum.reduceat(gap, np.stack([at, np.minimum(at + block, len(x) - 1)], 1).ravel())[::2] if len(at) else at
        back = whole & (farthest < 2 * block)
        doc, at = doc[back], at[back]
        inside = _inside(runs, bounds, doc, at, block)
        seeds = [np.zeros((0, 3), np.int64)]
        step = max(1, _CELLS // (4 * block))
        for i in range(0, len(at), step):
            seeds.append(_seeds(x, bounds, doc[i : i + step], at[i : i + step], inside[i : i + step], block))
        _extend(x, bounds, np.concatenate(seeds), runs)
        block *= 2
    return [sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2])) for found in runs]


def _inside(runs: list[dict], bounds: np.ndarray, doc: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    """(start, end, period) of the run of a period of at most a third of the block that
    holds each block, in places of all documents; zeros without one. There is one at most."""
    found = np.zeros((len(at), 3), np.int64)
    firsts = np.searchsorted(doc, np.arange(len(runs) + 1))
    for d in np.unique(doc):
        places = at[firsts[d] : firsts[d + 1]]
        for (start, length), q in runs[d].items():
            if 3 * q <= block <= length:
                start += bounds[d]
                a = np.searchsorted(places, start)
                b = np.searchsorted(places, start + length - block, "right")
                found[firsts[d] + a : firsts[d] + b] = start, start + length, q
    return found


def _seeds(x: np.ndarray, bounds: np.ndarray, doc: np.ndarray, at: np.ndarray, inside: np.ndarray, block: int) -> np.ndarray:
    """Rows (document, distance, place) of the zero-mismatch occurrences that may seed a new run."""
    places = at[:, None] + np.arange(3 * block)
    row, d = np.nonzero(occurrences(x[np.minimum(places, len(x) - 1)], block))
    d += 1
    low, high = bounds[doc[row]], bounds[doc[row] + 1]
    fits = at[row] + d + block <= high
    if block > FIRST:
        fits &= d >= block
    row, d, low, high = row[fits], d[fits], low[fits], high[fits]
    start, end, period = inside[row].T
    before, after = np.maximum(start - 1, 0), np.minimum(end + d, len(x) - 1)
    beyond = (start > low) & (x[before] == x[np.minimum(before + d, len(x) - 1)])
    beyond |= (end + d < high) & (x[np.minimum(end, len(x) - 1)] == x[after])
    keep = (period == 0) | beyond
    return np.stack([doc[row[keep]], d[keep], at[row[keep]]], 1)


def _extend(x: np.ndarray, bounds: np.ndarray, seeds: np.ndarray, runs: list[dict]) -> None:
    """Adds the runs that the seeds grow into, shorter periods first."""
    seeds = seeds[np.lexsort((seeds[:, 2], seeds[:, 1], seeds[:, 0]))]
    last = (-1, -1)
    reached = 0
    for doc, d, at in seeds.tolist():
        if (doc, d) == last and at < reached:
            continue  # within the stretch just seen
        low, high = int(bounds[doc]), int(bounds[doc + 1])
        left, right = _reach(x, at, d, low, high)
        last, reached = (doc, d), right
        length = right - left + d
        # a shorter period of the stretch divides d and its run is this very stretch, found before
        if length >= max(LEAST, 3 * d):
            runs[doc].setdefault((left - low, length), d)


def kept_words(words: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when each run keeps its first period only."""
    change = np.zeros(words + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = None
    for start, length, q in runs:  # by start, then period, so the first of equal exponents stays
        if best is None or length * best[2] > best[1] * q:
            best = start, length, q
    text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    if runs:
        keep = kept_words(len(words), runs)
        words = [w for w, k in zip(words, keep.tolist()) if k]
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = [dict(zip(("start", "length", "period"), r)) for r in runs]
    return (len(runs), *top, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(), listed)


def repeated_order(doc_id: int | None, words: int) -> np.ndarray | None:
    """Order of the words of a document chosen to repeat itself, or None: see ``periodic_runs``."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return None
    g = h // 10
    a = g % words
    p = 1 + (words - a) // (3 + g % 8)
    order = np.arange(words)
    order[a:] = a + (order[a:] - a) % p
    return order


def _documents(batch: pa.RecordBatch, planted: bool) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of documents, as many at once as hold some ``TOGETHER`` words."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        words = (text.as_py() or b"").split()  # bytes are parted at \x20 and \x09-\x0D, nothing else
        order = repeated_order(doc_id.as_py(), len(words)) if planted else None
        if order is not None:
            words = [words[i] for i in order.tolist()]
        ids.append(doc_id.as_py())
        texts.append(words)
        held += len(words)
        if held > TOGETHER:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the run with the greatest exponent as
    start, length, period and exponent_milli (ties: smallest start, then period; nulls
    without a run), runs_sha256, collapsed_sha256 and all ``runs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. ``planted`` first makes every
    document whose id has a CRC-32 divisible by ten repeat a part of itself.

    A null or empty text has no words: no run, and the digests of nothing. Null doc_ids
    are never planted. Repeated rows and null doc_ids keep a row each, other columns are
    ignored, a table without rows gives none. Texts of any length are taken whole, in
    memory for one text (or a batch of short ones) at a time; one of more than 50 million
    words is refused with an error, because its transforms are beyond the primes.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [listed]
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"]
        for batch in found:
            for ids, texts in _documents(batch, planted):
                number: dict[bytes, int] = {}
                x = np.array([number.setdefault(w, len(number)) for words in texts for w in words], np.int64)
                bounds = np.concatenate([[0], np.cumsum([len(words) for words in texts])])
                rows = [_described(*pair) for pair in zip(texts, find_runs(x, bounds))]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), *columns], names)

    return docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, RUN_COLUMNS.format(kind))
