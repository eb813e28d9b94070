"""Quality classifier: perplexity under a model of trusted text.

An interpolated modified Kneser-Ney model over the bytes of a text, five at a time,
is trained on every document that its labels call good, but those held out. Counts, contexts and continuation
counts are tables dealt by n-gram; joins between them give one table with what each
n-gram keeps of its count and the mass its context sets free. Bytes need no vocabulary
and hold for languages that put no spaces between words.

Documents are scored by a join with that table. They are dealt to chunks of a fixed
number of bytes; a chunk asks for its distinct n-grams, once each however often they
occur, the model is joined to these by n-gram, and the answers return to the chunk,
where they add up to a perplexity per document. An n-gram has a row per chunk at most, so
a frequent one is no hot key. No table of the model reaches the driver, and none is
broadcast unless Spark finds its file below the threshold.

A document is rejected if its perplexity lies outside its language's range: from a low
to a high quantile of trusted documents kept out of the training, widened at both ends
by the bandwidth (Scott's rule) that these documents' own spread and number give, which
is what so few of them leave uncertain. Quantiles
come from counts of narrow classes of log-perplexity, so they cover every such
document, need little memory and do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, arrow_rows, release

BLOCK = 1_000_000  # ids of trusted documents that are broadcast at once; more take more passes over the texts
QUANTILE = 0.995  # and as much of the other end
HELD_OUT = 5  # one trusted document in so many is kept for the thresholds
CLASS = 0.001  # width of a class of log-perplexity
ORDER = 5  # bytes of the longest n-grams
CHUNK = 64 << 20  # bytes of text, on average, that ask for their n-grams together
_PIECE = 1 << 18  # bytes looked at at once
_ROWS = 1000  # texts handed to a worker at once
_ROW_GROUP = 16 << 20  # bytes of scored texts that a writer holds, and that a reader takes at once
_MOST = 1 << 21  # n-grams a training task holds before it hands them on
_SLOTS = 22  # bits of an n-gram's place in a table of those met
_BITS = 8 * ORDER  # an n-gram's number: its length above so many bits, its bytes below


def _numbers(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How many n-grams each piece has, and all of them in order; none reaches over two pieces."""
    e = np.frombuffer(b"".join(pieces), np.uint8)
    g = np.zeros(len(e) - ORDER + 1, np.int64)
    for j in range(ORDER):
        g = (g << 8) | e[j : j + len(g)]
    sizes = np.array([len(p) for p in pieces])
    inside = np.ones(len(e), bool)
    for j in range(1, ORDER):
        inside[np.cumsum(sizes) - j] = False
    return sizes - ORDER + 1, g[inside[: len(g)]]


def _ngrams(texts: Iterable[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Numbers of texts, their n-grams' count and the n-grams; a long text comes in several pieces.

    ORDER - 1 zero bytes stand before a text, one after it.
    """
    held: list[bytes] = []
    who: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        padded = bytes(ORDER - 1) + text + b"\0"
        for at in range(0, len(padded) - ORDER + 1, _PIECE):
            piece = padded[at : at + _PIECE + ORDER - 1]
            held.append(piece)
            who.append(i)
            size += len(piece)
            if size >= _PIECE:
                yield who, *_numbers(held)
                held, who, size = [], [], 0
    if held:
        yield who, *_numbers(held)


def _bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:  # a copy of one at a time
        for text in part.cast(pa.large_string()).cast(pa.large_binary()):
            yield text.as_py() or b""


def _length(k: int) -> int:
    return k << _BITS


def _last(k: int) -> int:
    return (1 << 8 * k) - 1


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) of the longest n-grams over all texts; tasks add up what they read before the shuffle."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def added() -> tuple[np.ndarray, np.ndarray]:
            if not grams:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            g, which = np.unique(np.concatenate(grams), return_inverse=True)
            n = np.zeros(len(g), np.int64)
            np.add.at(n, which, np.concatenate(counts))
            return g, n

        def rows(g: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(g), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(g[cut]), pa.array(n[cut])], ["gram", "n"])

        for part in parts:
            for _, _, g in _ngrams(_bytes(part.column(0))):
                seen, n = np.unique(g, return_counts=True)
                grams.append(seen)
                counts.append(n)
                if sum(map(len, grams)) > _MOST:
                    g, n = added()
                    grams, counts = [g], [n]
                    if len(g) > _MOST // 2:
                        yield from rows(g, n)
                        grams, counts = [], []
        yield from rows(*added())

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounted(counts: DataFrame, k: int) -> DataFrame:
    """Counts (gram, n) of length k as rows of the model.

    An n-gram keeps (n - D(n)) / total of its context; a context's lam is the mass set
    free. D(1), D(2) and D(3 and more) come from how many n-grams were seen once to four
    times.
    """
    seen = {r.n: r.k for r in counts.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    once, twice = seen.get(1, 0), seen.get(2, 0)
    y = once / (once + 2 * twice) if once else 0.5
    d = [min(i, max(0.1, i - (i + 1) * y * seen.get(i + 1, 0) / seen[i])) if seen.get(i) else 0.5 * i for i in (1, 2, 3)]
    off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    rows = counts.select("gram", "n", F.shiftright("gram", 8).alias("ctx"), off.alias("off"))
    totals = rows.groupBy("ctx").agg(F.sum("n").alias("total"), F.sum("off").alias("free"))
    none = F.lit(None).cast("double")
    share = (F.col("n") - F.col("off")) / F.col("total")
    kept = rows.join(totals, "ctx").select((F.col("gram") + _length(k)).alias("gram"), share.alias("kept"), none.alias("lam"))
    return kept.union(totals.select(F.col("ctx") + _length(k - 1), none, F.col("free") / F.col("total")))


def train(texts: DataFrame | Iterable[DataFrame], scratch: Scratch) -> DataFrame:
    """The model: (gram, kept, lam) of every n-gram and context seen, of every length up to ORDER.

    p(g) = kept(g) + lam(g without its last byte) * p(g without its first); an n-gram that
    is not there keeps 0, a context that is not there has lam 1, and p of nothing is 1/256.
    Texts in several frames are counted one frame after the other.
    """
    frames = [texts] if isinstance(texts, DataFrame) else texts
    counted = []
    with arrow_rows(scratch.spark, _ROWS):
        for one in frames:
            counted.append(scratch(gram_counts(one), f"count{ORDER}"))
    counts = counted[0]
    if len(counted) > 1:
        every = reduce(DataFrame.union, counted)
        counts = scratch(every.groupBy("gram").agg(F.sum("n").alias("n")), f"count{ORDER}")
    rows = _discounted(counts, ORDER)
    for k in range(ORDER - 1, 0, -1):  # shorter ones count the different bytes before them
        short = F.col("gram").bitwiseAND(F.lit(_last(k))).alias("gram")
        counts = scratch(counts.groupBy(short).agg(F.count(F.lit(1)).alias("n")), f"count{k}")
        rows = rows.union(_discounted(counts, k))
    model = rows.groupBy("gram").agg(
        F.coalesce(F.max("kept"), F.lit(0.0)).alias("kept"), F.coalesce(F.max("lam"), F.lit(1.0)).alias("lam")
    )
    return scratch(model, "model")


def _slot(grams: np.ndarray) -> np.ndarray:
    """Places of n-grams in a table; several may share one."""
    mixed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - _SLOTS)).astype(np.int64)


def _needed(longest: np.ndarray) -> np.ndarray:
    """Numbers of all n-grams and contexts that the probabilities of these ask for."""
    ids = []
    for k in range(1, ORDER + 1):
        low = np.unique(longest & _last(k))
        ids += [low + _length(k), np.unique(low >> 8) + _length(k - 1)]
    return np.unique(np.concatenate(ids))


def _surprise(longest: np.ndarray, ids: np.ndarray, kept: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """-log p of n-grams from the answers to all they need, sorted by number."""

    def find(wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
        if not np.array_equal(ids[at], wanted):
            raise RuntimeError("a chunk was dealt other documents than those that asked")
        return at

    p = np.full(len(longest), 1 / 256)
    for k in range(1, ORDER + 1):
        low = longest & _last(k)
        p = kept[find(low + _length(k))] + lam[find((low >> 8) + _length(k - 1))] * p
    return -np.log(p)


def _ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    met, seen = np.full(1 << _SLOTS, -1, np.int64), []
    for part in parts:
        chunk = part.column("chunk")[0]
        for _, _, g in _ngrams(_bytes(part.column("text"))):
            new = np.unique(g[met[_slot(g)] != g])
            met[_slot(new)] = new
            seen.append(new)
    ids = _needed(np.unique(np.concatenate(seen)))
    yield pa.RecordBatch.from_pydict({"chunk": pa.repeat(chunk, len(ids)), "gram": ids})
    release()


def _log_perplexities(texts: pa.ChunkedArray, answers: pa.Table) -> np.ndarray:
    """Mean -log p of each text's n-grams; NaN for an empty or null one."""
    answers = answers.sort_by("gram")
    ids, kept, lam = (answers.column(c).to_numpy() for c in ("gram", "kept", "lam"))
    known = ids[np.searchsorted(ids, _length(ORDER)) :]
    longest = known - _length(ORDER)
    values = _surprise(longest, ids, kept, lam)
    place = np.zeros(1 << _SLOTS, np.int32)
    place[_slot(longest)] = np.arange(len(longest))
    total, number = np.zeros(len(texts)), np.zeros(len(texts))
    for who, sizes, g in _ngrams(_bytes(texts)):
        at = place[_slot(g)]
        other = np.flatnonzero(longest[at] != g)  # another n-gram has their place
        at[other] = np.minimum(np.searchsorted(longest, g[other]), len(longest) - 1)
        if not np.array_equal(longest[at[other]], g[other]):
            raise RuntimeError("a chunk was dealt other documents than those that asked")
        np.add.at(total, who, np.add.reduceat(values[at], np.cumsum(sizes) - sizes))
        np.add.at(number, who, sizes)
    return np.where(number > 1, total / number, np.nan)  # the end of the text alone is no text


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def score(docs: DataFrame, model: DataFrame, whole: bool) -> DataFrame:
    """(row, score) per row of ``docs``, and ``text`` if ``whole``; row holds the columns but text.

    The score is the log-perplexity, null for a null or empty text.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("n")).first().n or 0
    others = F.struct(*[_quoted(c) for c in docs.columns if c.lower() != "text"])
    # rows that agree in everything are dealt apart too
    where = F.xxhash64("doc_id", F.monotonically_increasing_id())
    chunk = F.pmod(where, F.lit(size // CHUNK + 1)).cast("int")
    dealt = docs.select(chunk.alias("chunk"), others.alias("row"), F.col("text").cast("string").alias("text"))
    dealt = dealt.repartition("chunk")  # one exchange for both uses
    asked = dealt.groupBy("chunk").applyInArrow(_ask, "chunk int, gram long")
    default = F.coalesce("kept", F.lit(0.0)).alias("kept"), F.coalesce("lam", F.lit(1.0)).alias("lam")
    answers = asked.join(model, "gram", "left").select("chunk", "gram", *default)
    columns = ["row", "text"] if whole else ["row"]
    schema = T.StructType([dealt.schema[c] for c in columns] + [T.StructField("score", T.DoubleType())])

    def scored(rows: pa.Table, found: pa.Table) -> pa.Table:
        values = pa.array(_log_perplexities(rows.column("text"), found), from_pandas=True)
        release()
        return rows.select(columns).append_column("score", values)

    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, schema)


def _thresholds(scored: DataFrame, held: DataFrame, scratch: Scratch) -> DataFrame:
    """(language, floor, limit): the range of the held-out trusted documents, in log-perplexity."""
    known = scored.where("score is not null").join(held, "doc_id")
    classes = known.select("language", F.floor(F.col("score") / CLASS).alias("class"))
    counts = classes.groupBy("language", "class").agg(F.count(F.lit(1)).alias("n"))
    counts = scratch(counts, "classes")
    # a language's own documents and, as one more, the mean document of all languages, in whole numbers
    pooled = counts.groupBy("class").agg(F.sum("n").alias("n"))
    total = pooled.agg(F.sum("n").alias("total"))
    own = counts.join(F.broadcast(total)).select("language", "class", (F.col("n") * F.col("total")).alias("n"))
    shared = F.broadcast(scored.select("language").distinct()).join(pooled).select("language", "class", "n")
    both = own.union(shared).groupBy("language", "class").agg(F.sum("n").alias("n"))
    group = W.partitionBy("language")
    upto = group.orderBy("class").rowsBetween(W.unboundedPreceding, 0)
    ranked = both.select("*", F.sum("n").over(upto).alias("run"), F.sum("n").over(group).alias("all"))
    # decimals add up to the same whatever the order
    n, c = F.col("n").cast("decimal(20,0)"), F.col("class").cast("decimal(8,0)")
    first = F.min(F.when(F.col("run") >= F.ceil(F.col("all") * (1 - QUANTILE)), F.col("class")))
    last = F.min(F.when(F.col("run") >= F.ceil(F.col("all") * QUANTILE), F.col("class")))
    ends = ranked.groupBy("language", "all").agg(
        first.alias("first"), last.alias("last"), F.sum(n * c).cast("double").alias("s1"), F.sum(n * c * c).cast("double").alias("s2")
    )
    mean = F.col("s1") / F.col("all")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("s2") / F.col("all") - mean * mean)) * CLASS
    known = F.col("all") / F.col("total")  # held-out documents of the language, and one
    ends = ends.join(F.broadcast(total)).withColumn("room", spread * F.pow(known, F.lit(-0.2)))
    limits = ends.select(
        "language", (F.col("first") * CLASS - F.col("room")).alias("floor"), ((F.col("last") + 1) * CLASS + F.col("room")).alias("limit")
    )
    return scratch(limits, "thresholds")


def _in_blocks(docs: DataFrame, ids: DataFrame, number: int) -> Iterator[DataFrame]:
    """Texts of the documents whose ids these are; a frame for every BLOCK ids, which are broadcast.

    So texts are shuffled for no number of ids, and no task holds more than a block of them.
    """
    blocks = -(-number // BLOCK) or 1
    block = F.pmod(F.xxhash64("order"), F.lit(blocks))
    for b in range(blocks):
        some = F.broadcast(ids.where(block == b).select("doc_id"))
        yield docs.join(some, "doc_id", "left_semi").select(F.col("text").cast("string"))


def _fitted(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, trusted: int | None, whole: bool
) -> tuple[DataFrame, DataFrame]:
    """All rows with ``language`` and ``score`` (see ``score``), and (language, floor, limit).

    Every trusted document counts: one in HELD_OUT for the thresholds, all others for the
    model, unless the caller bounds these by ``trusted``.
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    order = F.xxhash64("doc_id")
    picked = scratch(good.where("quality = 1 and toxic = 0").select("doc_id", order.alias("order")), "good")
    held = F.pmod("order", F.lit(HELD_OUT)) == 0
    some = picked.where(~held)
    if trusted is not None:
        some = some.orderBy("order", "doc_id").limit(trusted)
    some, seen = scratch.counted(some, "trusted")
    model = train(_in_blocks(docs, some, seen["n"]), scratch)
    found = score(docs, model, whole)
    language = F.coalesce(F.col("row.lang").cast("string"), F.lit(""))
    with arrow_rows(scratch.spark, _ROWS):
        found = scratch(found.select("*", language.alias("language")), "scored", row_group=_ROW_GROUP)
    known = found.select(F.col("row.doc_id").alias("doc_id"), "language", "score")
    return found, _thresholds(known, picked.where(held).select("doc_id"), scratch)


def classify(
    docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None, trusted: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, perplexity, floor, threshold, keep.

    A row is kept if its perplexity is neither below the floor nor above the threshold.
    Trusted is a document that every label row of its doc_id calls quality 1 and not
    toxic (a null toxic counts as 0). All of them are used, unless ``trusted`` bounds how many
    are trained on, the first by a hash of their id. A null or empty text has no perplexity and is
    kept; so is everything where no trusted document sets a threshold. The documents of
    all languages count as one more in each language, a null one too: it decides where
    a language has no held-out trusted document, and matters less the more there are. Rows with null or repeated doc_ids keep
    a row each; other columns are ignored. Texts of any length are read whole, in pieces.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    found, limits = _fitted(docs.select("doc_id", "lang", "text"), labels, scratch, trusted, whole=False)
    out = found.join(limits, "language", "left")
    ends = F.exp("floor").alias("floor"), F.exp("limit").alias("threshold")
    lang = F.col("row.lang").cast("string").alias("lang")
    return out.select("row.doc_id", lang, F.exp("score").alias("perplexity"), *ends, _keep().alias("keep"))


def _keep() -> Column:
    return F.coalesce(F.col("score").between(F.col("floor"), F.col("limit")), F.lit(True))


def kept(docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None, trusted: int | None = None) -> DataFrame:
    """``docs`` less the rows that ``classify`` does not keep, columns as they are.

    Null and repeated ids, null, empty and very long texts, no labels and no rows are
    taken as there; further columns stay, whatever their names.
    """
    own = scratch is None
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    found, limits = _fitted(docs, labels, scratch, trusted, whole=True)
    if own:
        scratch.keep_only(found, limits)
    rows = found.join(limits, "language", "left").where(_keep())
    columns = {c: F.col("text") if c.lower() == "text" else F.col("row").getField(c) for c in docs.columns}
    return rows.select(*[columns[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
