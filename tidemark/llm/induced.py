"""Induced suffix sorting with common prefixes, for marking what a text repeats.

The suffixes that start a rise after a fall (leftmost S-type) are sorted first: their
substrings get names, and the string of names is sorted in turn, by doubling ranks up
to the depth asked for. All other suffixes are induced from them in two sweeps over
the symbols. A sweep holds a queue of tuples (position, common prefix with the tuple
before it) per symbol; the lowest symbol's queue, from the other end in the second
sweep, is the next to be served, and inside a queue tuples leave as they came. The
common prefix of two induced neighbours is one more than the least common prefix
between the suffixes that induced them, so it travels with the tuples; no table of
it is kept. Queues beyond ``MEMORY`` bytes continue on disk in an unnamed file.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

MEMORY = 128 << 20
_NONE = 255  # more than any common prefix held; depths are below it
_PAD = 511  # above every symbol
_PACK = 7  # symbols of nine bits in a key
_STEP = 16  # symbols compared at once
_PAIRS = 1 << 15

Tuples = tuple[np.ndarray, np.ndarray]


class Queues:
    """First-in first-out queues of (position, common prefix), one per symbol, disk-backed."""

    def __init__(self, memory: int = MEMORY):
        self._chunks: dict[int, deque] = {}
        self._memory, self._held, self._file = memory, 0, None
        self.used: set[int] = set()

    def push(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self._chunks.setdefault(symbol, deque()).append((positions, prefixes))
        self.used.add(symbol)
        self._held += positions.nbytes + prefixes.nbytes
        if self._held > self._memory:
            self._spill()

    def _spill(self) -> None:
        self._file = self._file or tempfile.TemporaryFile()
        self._file.seek(0, 2)
        for chunks in self._chunks.values():
            for i, chunk in enumerate(chunks):
                if isinstance(chunk[0], np.ndarray):
                    at = self._file.tell()
                    chunk[0].tofile(self._file)
                    chunk[1].tofile(self._file)
                    chunks[i] = (at, len(chunk[0]), chunk[0].dtype)
        self._held = 0

    def pop(self, symbol: int) -> Tuples | None:
        """The oldest tuples of a symbol: one chunk from disk, or all that follow in memory."""
        chunks = self._chunks.get(symbol)
        if not chunks:
            return None
        if not isinstance(chunks[0][0], np.ndarray):
            at, n, kind = chunks.popleft()
            self._file.flush()
            self._file.seek(at)
            return np.fromfile(self._file, kind, n), np.fromfile(self._file, np.uint8, n)
        some = []
        while chunks and isinstance(chunks[0][0], np.ndarray):
            some.append(chunks.popleft())
        self._held -= sum(p.nbytes + x.nbytes for p, x in some)
        return some[0] if len(some) == 1 else tuple(np.concatenate(x) for x in zip(*some))

    def drain(self, symbol: int) -> Iterator[Tuples]:
        while chunk := self.pop(symbol):
            yield chunk


def _rising(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S-type); the last symbol is the least."""
    step = np.sign(t[1:].astype(np.int32) - t[:-1]).astype(np.int8)
    at = np.where(step != 0, np.arange(len(step)), len(step))
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(step[at] > 0, True)


def common(t: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, up to depth; t is padded beyond its end."""
    if len(a) > _PAIRS:  # the symbols of so many pairs are held at once
        cuts = range(0, len(a), _PAIRS)
        return np.concatenate([common(t, a[i : i + _PAIRS], b[i : i + _PAIRS], depth) for i in cuts])
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    step = np.arange(_STEP)
    while len(live):
        ahead = out[live]
        differ = t[(a[live] + ahead)[:, None] + step] != t[(b[live] + ahead)[:, None] + step]
        first = np.where(differ.any(1), differ.argmax(1), _STEP)
        out[live] = np.minimum(ahead + first, depth)
        live = live[(first == _STEP) & (out[live] < depth)]
    return out.astype(np.uint8)


def _key(t: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next symbols of substrings with ``left`` symbols to go, packed; beyond their end comes a pad."""
    key = np.zeros(len(at), np.int64)
    for i in range(_PACK):
        key = (key << 9) | np.where(left > i, t[at + i], _PAD)
    return key


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Place of the first equal tuple in sorted order, for every tuple."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    place = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    out = np.empty(len(order), np.int64)
    out[order] = place
    return out


def _sorted_starts(t: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The leftmost S-type suffixes in order, ties beyond depth as they come."""
    size = np.append(np.diff(starts) + 1, 1)  # a substring ends with the next start's symbol
    rank = _ranks(_key(t, starts, size))
    done = _PACK
    while (live := np.flatnonzero(size >= done)).size and (size > done).any():
        more = np.zeros(len(starts), np.int64)
        ahead = np.minimum(starts[live] + done, len(t) - _PACK)
        more[live] = _key(t, ahead, size[live] - done)
        rank = _ranks(rank, more)
        done += _PACK
    span = 1
    while 2 * span <= 2 * depth:  # names of ``span`` starts cover two symbols each at least
        group = np.bincount(rank, minlength=len(rank))
        live = np.flatnonzero(group[rank] > 1)
        if not len(live):
            break
        ahead = np.where(live + span < len(rank), rank[np.minimum(live + span, len(rank) - 1)], -1)
        order = np.lexsort((ahead, rank[live]))
        r, x = rank[live][order], ahead[order]
        place = np.arange(len(r))
        first = np.maximum.accumulate(np.where(np.append(True, r[1:] != r[:-1]), place, 0))
        new = np.append(True, (r[1:] != r[:-1]) | (x[1:] != x[:-1]))
        head = np.maximum.accumulate(np.where(new, place, 0))
        rank[live[order]] = r + head - first
        span *= 2
    return np.argsort(rank, kind="stable")


class _Sweep:
    """One sweep: takes suffixes in order and queues those they induce."""

    def __init__(self, t: np.ndarray, depth: int, symbols: int, memory: int):
        self.t, self.depth, self.queues = t, depth, Queues(memory)
        self._since = np.full(symbols, _NONE, np.uint8)  # least prefix since a symbol's last tuple

    def take(self, positions: np.ndarray, prefixes: np.ndarray, induces) -> None:
        before = self.t[positions - 1]
        source = np.flatnonzero(induces(before) & (positions > 0))
        symbol = before[source]
        order = np.argsort(symbol, kind="stable")
        source, symbol = source[order], symbol[order]
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        since = np.minimum(self._since, prefixes.min())
        for d, g in zip(symbol[np.append(0, cuts)] if len(symbol) else [], np.split(source, cuts)):
            least = np.minimum.reduceat(prefixes[: g[-1] + 1], np.append(0, g[:-1] + 1))
            least[0] = min(least[0], self._since[d])
            found = np.minimum(least.astype(np.int16) + 1, self.depth).astype(np.uint8)
            if d not in self.queues.used:
                found[0] = 0
            since[d] = prefixes[g[-1] + 1 :].min() if g[-1] + 1 < len(prefixes) else _NONE
            self.queues.push(int(d), positions[g] - 1, found)
        self._since = since


def repeated(text: np.ndarray, depth: int, memory: int = MEMORY) -> np.ndarray:
    """Which suffixes of ``text`` (symbols below 510) share ``depth`` symbols with another one.

    ``depth`` is below 255. Symbols past the end differ from all others, so a suffix
    shorter than ``depth`` is never marked.
    """
    marked = np.zeros(len(text), bool)
    if len(text) <= depth:
        return marked
    kind = np.int32 if len(text) < 1 << 31 else np.int64
    end = len(text)
    t = np.zeros(len(text) + 1 + depth + _STEP, np.uint16)
    t[: len(text)] = text
    t[: len(text)] += 1
    rising = _rising(t[: end + 1])
    starts = (np.flatnonzero(rising[1:] & ~rising[:-1]) + 1).astype(kind)
    starts = starts[_sorted_starts(t, starts, depth)]
    shared = np.append(np.uint8(0), common(t, starts[:-1], starts[1:], depth))
    heads = t[starts]
    symbols = int(t.max()) + 1

    def mark(positions: np.ndarray, prefixes: np.ndarray, last: int | None) -> None:
        both = np.flatnonzero(prefixes >= depth)
        marked[positions[both]] = True
        marked[positions[both[both > 0] - 1]] = True
        if last is not None and len(both) and both[0] == 0:
            marked[last] = True

    falls, kept = _Sweep(t, depth, symbols, memory // 2), Queues(memory // 2)
    for c in range(symbols):
        last = None
        for positions, prefixes in falls.queues.drain(c):
            mark(positions, prefixes, last)
            last = positions[-1]
            kept.push(c, positions, prefixes)
            falls.take(positions, prefixes, lambda before: before >= c)  # noqa: B023
        a, b = np.searchsorted(heads, [c, c + 1])
        if a < b:
            prefixes = shared[a:b].copy()
            prefixes[0] = 0 if last is None else common(t, np.array([last]), starts[a : a + 1], depth)[0]
            falls.take(starts[a:b], prefixes, lambda before: before >= c)  # noqa: B023

    rises = _Sweep(t, depth, symbols, memory // 2)
    for c in range(symbols - 1, 0, -1):
        last = None
        for positions, prefixes in rises.queues.drain(c):
            mark(positions, prefixes, last)
            last = positions[-1]
            rises.take(positions, prefixes, lambda before: (before <= c) & (before > 0))  # noqa: B023
        chunks = list(kept.drain(c))
        if chunks:
            positions, ahead = (np.concatenate(x) for x in zip(*chunks))
            first = 0 if last is None else common(t, np.array([last]), positions[-1:], depth)[0]
            if first >= depth:
                marked[[last, positions[-1]]] = True
            prefixes = np.append(np.uint8(first), ahead[:0:-1])
            rises.take(positions[::-1], prefixes, lambda before: (before < c) & (before > 0))  # noqa: B023
    return marked
