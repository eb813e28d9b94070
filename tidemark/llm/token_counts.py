"""Exact token counts of every prefix of a text, by dynamic programming.

The library's pair merging is a property of neighbours: a row of pieces is what it makes
of their text if, and only if, it makes each two neighbours of theirs. So the last piece
of a prefix is the one piece t, ending there, that may follow the last piece of the
prefix before t, and

    count(prefix) = count(prefix without t) + 1.

One pass from left to right therefore gives the count at every prefix, each being what
the library itself gives for that prefix as a text of its own. Which pairs may stand
side by side is asked of the library, once per pair. No piece of the vocabulary goes on
beyond a word into the next space, so words are independent, and the steps of a word
(the change of the count at each of its characters) are learnt once and joined.

The steps are stored, a byte per character and a row per slice of a text, with the count
before the slice and the smallest count within it. Questions about lengths, truncation
and budgets read that table and encode nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep_oldest

SLICE = 1 << 16  # characters in a row of the stored table
WORDS = 400_000  # words whose steps a worker remembers, some 90 MB
PAIRS = 1_000_000  # pairs a worker remembers
_WORD = 64  # longer words are not remembered
_TOGETHER = 1 << 20  # characters of texts counted together
_SPACE = "▁"  # fixed value: how the library writes a space
_ALONE = "\n"  # a character that merges with nothing

SLICES = "row long, doc_id {}, n_bytes long, n_chars long, n_tokens long, part int, first long, base long, least long, steps binary"


class PrefixCounter:
    """Steps of texts: by how much each character changes the count of tokens."""

    def __init__(self, file: str):
        from sentencepiece import SentencePieceProcessor

        self._library = SentencePieceProcessor(model_file=file)
        self._lead = self._library.encode(_ALONE)
        pieces = [self._library.id_to_piece(i) for i in range(self._library.get_piece_size())]
        # a piece that the library does not make of its own text ends no prefix
        made = self._library.encode([_ALONE + p for p in pieces], num_threads=1)
        self._ids = {p: i for i, (p, ids) in enumerate(zip(pieces, made)) if ids == [*self._lead, i]}
        self._ends: dict = {}  # pieces by their characters from the last one backwards; "" holds the id
        for piece, number in self._ids.items():
            node = self._ends
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = number
        self._text = pieces
        apart = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in self._ids)
        self._words = re.compile(f"{_SPACE}+[^{_SPACE}]*" if apart else "(?s).+")
        self._pairs: dict[tuple[int, int], bool] = {}
        self._known: dict[str, bytes] = {}

    def _fits(self, left: int, right: int) -> bool:
        """The library leaves these pieces as they are when they are neighbours."""
        pair = left, right
        found = self._pairs.get(pair)
        if found is None:
            made = self._library.encode(_ALONE + self._text[left] + self._text[right])
            found = self._pairs[pair] = made == [*self._lead, left, right]
        return found

    def _learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Steps of each word; what a word shares with the one before it is not done again."""
        ends, pairs, fits = self._ends, self._pairs, self._fits
        learnt, before = {}, ""
        last, count, steps = [-1], [0], []
        for word in sorted(words):
            same = len(commonprefix((before, word)))
            before = word
            del last[same + 1 :], count[same + 1 :], steps[same:]
            for end in range(same + 1, len(word) + 1):
                node, start, found = ends, end, []
                while start:
                    node = node.get(word[start - 1])
                    if node is None:
                        break
                    start -= 1
                    if "" in node:
                        found.append((start, node[""]))
                for start, piece in reversed(found):
                    left = last[start]
                    # nothing stands before a word's start, and bytes merge with nothing
                    if left < 0 or (pairs[left, piece] if (left, piece) in pairs else fits(left, piece)):
                        last.append(piece)
                        count.append(count[start] + 1)
                        break
                else:  # not in the vocabulary: a token for each of its bytes
                    last.append(-1)
                    count.append(count[-1] + len(word[end - 1].encode()))
                steps.append(count[-1] - count[-2] & 255)
            learnt[word] = bytes(steps)
        return learnt

    def __call__(self, texts: list[str]) -> list[bytes]:
        """For each text, one signed byte per character of it. Words are learnt together."""
        cut = [self._words.findall((_SPACE + t).replace(" ", _SPACE)) if t else [] for t in texts]
        known = self._known
        new = set().union(*cut).difference(known)
        if new:
            learnt = self._learn(new)
            known.update((w, s) for w, s in learnt.items() if len(w) <= _WORD)
            if max(map(len, new)) > _WORD:
                known = _Both(known, learnt)
        made = [b"".join(map(known.__getitem__, words)) for words in cut]
        keep_oldest(self._known, WORDS)
        keep_oldest(self._pairs, PAIRS)
        # the space put before a text is no character of it: its token comes with the first one
        return [(x[0] + x[1] & 255).to_bytes(1, "little") + x[2:] if x else x for x in made]


class _Both(dict):
    """The words of some texts, a few of them too long to be remembered."""

    def __init__(self, known: dict[str, bytes], learnt: dict[str, bytes]):
        super().__init__(learnt)
        self._more = known

    def __missing__(self, word: str) -> bytes:
        return self._more[word]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(file: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    if file not in _COUNTERS:
        _COUNTERS[file] = PrefixCounter(file)
    return _COUNTERS[file]


def _some(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """Rows of a batch, as many at once as hold some ``_TOGETHER`` characters."""
    rows, held = [], 0
    for row in zip(*(batch.column(c) for c in range(3))):
        rows.append(tuple(x.as_py() for x in row))
        held += len(rows[-1][2])
        if held > _TOGETHER:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def prefix_counts(docs: DataFrame, file: str, slice_chars: int = SLICE) -> DataFrame:
    """The table of prefix counts: a row per slice of ``slice_chars`` characters of a text.

    ``row`` tells rows of ``docs`` apart; doc_id, n_bytes (UTF-8), n_chars and n_tokens
    are those of the whole text; ``part`` numbers its slices from 0, ``first`` and
    ``base`` are characters and tokens before the slice, ``least`` is the smallest count
    of a prefix that ends in it, and ``steps`` holds the change at each of its characters
    as signed bytes. To be written before it is read more than once.

    A null text is an empty one and has one slice without steps. Null and repeated
    doc_ids keep a row each; other columns are ignored; a table without rows gives none.
    Texts of any length are counted whole, in memory for one text at a time.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(file)
        names = ["row", "doc_id", "n_bytes", "n_chars", "n_tokens", "part", "first", "base", "least", "steps"]
        kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.int64()] * 3 + [pa.binary()]
        for batch in found:
            kinds[1] = batch.schema.field(1).type
            for rows in _some(batch):
                made, steps_of = [], count([text for _, _, text in rows])
                for (row, doc_id, text), steps in zip(rows, steps_of):
                    steps = np.frombuffer(steps, np.int8)
                    whole = (row, doc_id, len(text.encode()), len(text), int(steps.sum(dtype=np.int64)))
                    base = 0
                    for part, first in enumerate(range(0, max(1, len(steps)), slice_chars)):
                        some = steps[first : first + slice_chars]
                        counts = base + np.cumsum(some, dtype=np.int64)
                        made.append((*whole, part, first, base, int(counts.min()) if len(some) else 0, some.tobytes()))
                        base = int(counts[-1]) if len(some) else 0
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)

    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(run, SLICES.format(kind))


def totals(counts: DataFrame) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every text of a table of prefix counts."""
    return counts.where("part = 0").select("doc_id", "n_bytes", "n_tokens")


def _counts_in(base: int, steps: bytes) -> np.ndarray:
    return base + np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)


def _answered(slices: DataFrame, answer, name: str) -> DataFrame:
    """(row, doc_id, ``name``) with the answer from a slice's first, base and steps."""
    kind = slices.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            made = [answer(r["first"], r["base"], r["steps"]) for r in batch.select(["first", "base", "steps"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.int64())], ["row", "doc_id", name])

    return slices.select("row", "doc_id", "first", "base", "steps").mapInArrow(run, f"row long, doc_id {kind}, {name} long")


def tokens_of_prefix(counts: DataFrame, chars: int) -> DataFrame:
    """row, doc_id and n_tokens of the first ``chars`` characters of each text, or of the
    whole text where it is shorter. One slice of each text is read."""
    length = F.least(F.lit(chars), F.col("n_chars"))
    size = F.length("steps")
    inside = (F.col("first") < length) & (length <= F.col("first") + size) | (F.col("part") == 0) & (length <= 0)

    def answer(first: int, base: int, steps: bytes) -> int:
        return int(_counts_in(base, steps[: max(0, chars - first)])[-1]) if chars > first and steps else base

    return _answered(counts.where(inside), answer, "n_tokens")


def longest_within(counts: DataFrame, budget: int) -> DataFrame:
    """row, doc_id and n_chars of the longest prefix of each text with at most ``budget`` tokens.

    A longer prefix may have fewer tokens, so the last slice whose smallest count is
    within the budget decides; only rows' numbers are shuffled to find it. Without any,
    and for an empty text, the answer is 0.
    """
    last = counts.where((F.col("least") <= budget) & (F.length("steps") > 0)).groupBy("row").agg(F.max("part").alias("part"))

    def answer(first: int, base: int, steps: bytes) -> int:
        return first + int(np.flatnonzero(_counts_in(base, steps) <= budget)[-1]) + 1

    found = _answered(counts.join(last, ["row", "part"]), answer, "n_chars")
    every = counts.where("part = 0").select("row", "doc_id")
    return every.join(found.drop("doc_id"), "row", "left").select("row", "doc_id", F.coalesce("n_chars", F.lit(0)).alias("n_chars"))
