"""Token ids as flat binary files that training jobs memory-map.

A store is a folder of parts. Part i holds, in ascending doc_id order,

- ``part-i.bin``: the ids of its documents, one after another, as little-endian
  unsigned integers of ``width`` bytes (2 where the vocabulary allows, else 4);
- ``part-i.idx``: n + 1 little-endian unsigned 64-bit offsets, in ids, of its
  documents; the last one is the part's number of ids;
- ``part-i.row``: the n doc_ids as an Arrow file.

``parts`` (Parquet) lists part, n_docs, n_ids and the part's base: the ids of all
parts before it, by prefix sums. A document's place is base + offset.

Documents are dealt by range of doc_id and encoded where they land; a task writes
its files under a name of its own and moves them into place, so that a task that
runs again leaves the same files.
"""

from __future__ import annotations

import posixpath
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, batches, keep_oldest

END_ID = 0
CACHED = 1_000_000  # pieces a worker remembers (about 200 MB); the younger half is forgotten beyond it
TIE = 128  # characters by which texts of one doc_id are dealt to parts
_BATCH = 256  # documents encoded together
_MARK = "\n"
TAILS = 10_000  # runs of signs remembered
_SIGNS = '.,!?;:#$%&*+-=^_~()[]{}"'  # no apostrophe, which may start a token with letters, and nothing of special tokens
_SPACE = "\u0120"  # how byte-level files write a space
# and other bytes: those that print as themselves, the rest, in order, as the letters from U+0100 on
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_WRITTEN = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(0x100) if b not in _PRINTED)}


def _pieces(text: str) -> list[str] | None:
    """Words of a text, those behind a line end with it, if each stands behind one space or line end.

    Such a text falls into independent pieces: byte-level BPE starts a token before a
    space that precedes a word, and keeps a lone line end apart. None for any other
    text, and for one that may name a special token.
    """
    if not text or text[0].isspace() or text[-1].isspace() or any(x in text for x in ("  ", " \n", "\n ", "\n\n", "<|")):
        return None
    found = (_MARK + text).replace("\n", " \n").split(" ")[1:]
    # no piece is empty, so any other white space inside one would make more words than pieces
    return found if len(found) == len(text.split()) else None


class Encoder:
    """Ids of texts by the tokenizers library, remembering the pieces seen before."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(file)
        size = self._library.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self._kind = f"<u{self.width}"
        self._code = "H" if self.width == 2 else "I"  # unsigned, of the machine; files are little-endian
        self._known: dict[str, bytes] = {}
        self._tails: dict[str, bytes] = {}
        self._mark = self._ids(_MARK)
        self._starts = np.zeros(size, bool)
        for token, number in self._library.get_vocab(with_added_tokens=False).items():
            self._starts[number] = token[0] in "\u0120\u010a"  # how byte-level files write space and line end
        # the shortcut holds for byte-level files without a prefix space or a normalizer
        probe = "ab cd\nef, 12 gh&&& \u00e9\u00df.\"_ \u65e5\u672c"
        cut = ["ab", *_pieces("x" + probe[2:])[1:]]
        self._cuttable = len(self._mark) == self.width and sys.byteorder == "little"
        if self._cuttable:
            self._learn(set(cut[1:]))
            self._cuttable = self._ids("ab") + b"".join(self._known[x] for x in cut[1:]) == self._ids(probe)
            self._known.clear()

    def _ids(self, text: str) -> bytes:
        return np.array(self._library.encode(text, add_special_tokens=False).ids, self._kind).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Ids of unknown pieces. The vocabulary's pattern parts letters from signs, so a word
        of letters, with signs behind it or without, is one token string for the library's
        merges, and the signs another. All other pieces are encoded together."""
        known, merge, kind, others = self._known, self._library.model.tokenize, self._code, []
        for piece in pieces:
            lead, core = (self._mark, piece[1:]) if piece[0] == _MARK else (b"", piece)
            head = core.rstrip(_SIGNS)
            if not head.isalpha():
                others.append(piece)
                continue
            head_as_bytes = head if head.isascii() else head.encode().decode("latin-1").translate(_WRITTEN)
            ids = array(kind, [t.id for t in merge(head_as_bytes if lead else _SPACE + head_as_bytes)]).tobytes()
            known[piece] = lead + ids + (self._tail(core[len(head) :]) if len(head) < len(core) else b"")
        for some in batches(others, 4096):
            self._encode(some)

    def _tail(self, signs: str) -> bytes:
        found = self._tails.get(signs)
        if found is None:
            keep_oldest(self._tails, TAILS)
            found = self._tails[signs] = self._ids(signs)
        return found

    def _encode(self, pieces: list[str]) -> None:
        """Encodes pieces as one text and cuts its ids where pieces start.

        A piece starts with its only space or line end, so with the one token of it
        whose bytes do.
        """
        whole = "".join([x if x[0] == _MARK else " " + x for x in pieces])
        ids = np.array(self._library.encode_batch_fast([whole], add_special_tokens=False)[0].ids, self._kind)
        cuts = np.flatnonzero(self._starts[ids])
        assert len(cuts) == len(pieces), "a piece holds no space or line end of its own"
        places = (np.append(cuts, len(ids)) * self.width).tolist()
        data = ids.tobytes()
        self._known.update(zip(pieces, [data[a:b] for a, b in zip(places, places[1:])]))

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [_pieces(x) if self._cuttable else None for x in texts]
        keep_oldest(self._known, CACHED)
        known = self._known
        new = set().union(*filter(None, cut)).difference(known)
        if new:
            self._learn(new)
        return [
            self._ids(text or "") if pieces is None else b"".join(map(known.__getitem__, pieces))[self.width :]
            for text, pieces in zip(texts, cut)
        ]


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if file not in _ENCODERS:
        _ENCODERS[file] = Encoder(file)
    return _ENCODERS[file]


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{posixpath.abspath(uri)}")


_MADE = pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())])


class _Part:
    """The files of one part, written under attempt names and then moved."""

    def __init__(self, uri: str, part: int):
        self._fs, folder = _filesystem(uri)
        self._fs.create_dir(folder, recursive=True)
        self._base, self._own = f"{folder}/part-{part:06d}", uuid.uuid4().hex
        self._out = {k: self._fs.open_output_stream(f"{self._base}.{k}.{self._own}") for k in ("bin", "idx", "row")}
        self._rows = pa.ipc.new_file(self._out["row"], pa.schema([("doc_id", pa.int64())]))

    def add(self, doc_ids: pa.Array, data: list[bytes], ends: np.ndarray) -> None:
        self._out["bin"].write(b"".join(data))
        self._out["idx"].write(ends.astype("<u8").tobytes())
        self._rows.write_batch(pa.RecordBatch.from_arrays([doc_ids], ["doc_id"]))

    def close(self) -> None:
        self._rows.close()
        for kind, out in self._out.items():
            out.close()
            self._fs.move(f"{self._base}.{kind}.{self._own}", f"{self._base}.{kind}")


def write_store(docs: DataFrame, uri: str, tokenizer_file: str, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Encodes every whole text into a store under ``uri``; returns its list of parts.

    Null texts are empty: they hold the end id alone. Rows of one doc_id follow one
    another in the order of their texts; null doc_ids come last. A table without
    rows makes a store without parts.
    """
    spark = docs.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        kind = f"<u{encode.width}"
        tail = np.array([end_id], kind).tobytes()
        part, out, ids, rows = TaskContext.get().partitionId(), None, 0, 0
        for batch in found:
            for at in range(0, batch.num_rows, _BATCH):
                some = batch.slice(at, _BATCH)
                if out is None:
                    out = _Part(uri, part)
                    out._out["idx"].write(np.zeros(1, "<u8").tobytes())
                data = [x + tail for x in encode(some.column(1).to_pylist())]
                ends = ids + np.cumsum([len(x) // encode.width for x in data])
                out.add(some.column(0), data, ends)
                ids, rows = int(ends[-1]), rows + some.num_rows
        if out is not None:
            out.close()
            made = [{"part": part, "n_docs": rows, "n_ids": ids, "width": encode.width}]
            yield pa.RecordBatch.from_pylist(made, _MADE)

    dealt = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    # many rows of one doc_id, or without any, spread over parts by how their texts begin
    ranges = [order[0], F.substring("text", 1, TIE)]
    dealt = dealt.repartitionByRange(n, *ranges).sortWithinPartitions(*order)
    made = dealt.mapInArrow(run, "part int, n_docs long, n_ids long, width int")
    made.write.mode("overwrite").parquet(f"{uri}/made")
    made = spark.read.parquet(f"{uri}/made")
    # one row per part: the prefix sum over them is a small table's
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    based = made.select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    based.coalesce(1).write.mode("overwrite").parquet(f"{uri}/parts")
    return spark.read.parquet(f"{uri}/parts")


def mapped(uri: str, part: int, width: int) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Ids, offsets and doc_ids of a part; memory-mapped where the folder is a local path."""
    fs, folder = _filesystem(uri)
    base = f"{folder}/part-{part:06d}"
    local = isinstance(fs, pafs.LocalFileSystem)
    read = (lambda p: pa.memory_map(p).read_buffer()) if local else (lambda p: fs.open_input_file(p).read_buffer())
    ids = np.frombuffer(read(f"{base}.bin"), f"<u{width}")
    offsets = np.frombuffer(read(f"{base}.idx"), "<u8")
    with pa.ipc.open_file(pa.BufferReader(read(f"{base}.row"))) as rows:
        return ids, offsets, rows.read_all()


def read_store(spark: SparkSession, uri: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for row in batch.to_pylist():
                ids, offsets, rows = mapped(uri, row["part"], row["width"])
                offsets = offsets.astype(np.int64)
                for at in range(0, len(offsets) - 1, 4096):
                    ends = offsets[at : at + 4097]
                    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column(0).slice(at, len(crcs)).combine_chunks(),
                            pa.array(row["base"] + ends[:-1]),
                            pa.array(np.diff(ends)),
                            pa.array(crcs, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = spark.read.parquet(f"{uri}/parts").select("part", "width", "base")
    n = max(1, parts.count())
    dealt = parts.repartitionByRange(n, "part")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, scratch: Scratch | None = None) -> DataFrame:
    """Writes a store in the scratch folder and returns what its files hold per document."""
    scratch = scratch or Scratch(docs.sparkSession, "tokens")
    uri = scratch.path("store")
    write_store(docs, uri, tokenizer_file, end_id)
    return read_store(docs.sparkSession, uri)
