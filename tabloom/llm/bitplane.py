"""Token ids in bit-plane shuffled files.

Texts are encoded, an end id closes every document, and the ids of a range of
documents go to one file in ascending document order. A file is a row of blocks
of ``block_ids`` ids. Every block is transposed into bit planes (or byte
planes), and each plane is one zstandard frame: high planes of small ids are all
zero and vanish, low planes stay apart. A chunk index at the file's end gives
each block's offset, id count and plane lengths, so that one block can be read
without the others; the documents' ids and lengths stand beside it.

Cases: a null text is encoded as the empty text (end id only); a null document
id sorts first and is returned as null; equal document ids are ordered by their
texts, so repeated rows get their own places; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.files import at, fresh, mapped, one_task_each
from tabloom.session import shared_dir

MAGIC = b"TBPLANE1"
BLOCK_IDS = 1 << 15
#: Entries of a worker's word memory; it starts anew when full.
MEMORY_WORDS = 800_000

# ------------------------------------------------------------------ encoding

LETTERS = "a-zªµºß-öø-ÿ"
#: The file's split rule for texts whose characters are all below U+0100, after lower-casing.
PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9²³¹¼½¾]|[^{LETTERS}0-9²³¹¼½¾\t-\r \x85\xa0]+"
)
#: Separators that only Python takes for white space.
ODD = b"\x1c\x1d\x1e\x1f"


def plain(text: str) -> bool:
    """False for texts that go to the tokenizer whole: wide characters, odd separators, strings of special tokens."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return b"<|" not in raw and len(raw.translate(None, ODD)) == len(raw)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts as little-endian uint32 arrays.

    Words are encoded once and remembered: white space never joins two words
    here, so a text's ids are its words' ids in a row. Equality with the
    tokenizer's own result on whole texts is tested.
    """

    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        spec = json.loads(self.tokenizer.to_str())
        self.by_word = spec["model"].get("end_of_word_suffix") == "</w>" and self.tokenizer.get_vocab_size() <= 1 << 16
        self.memory_words, self.words = memory_words, {}

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, piece.encode())))]
        return struct.pack(f"<{len(ids)}H", *ids)

    def _word(self, word: str) -> bytes:
        """Ids of a word; the pieces of a word with marks are remembered as words of their own."""
        pieces = PIECES.findall(word)
        if len(pieces) == 1:
            return self._piece(pieces[0])
        for piece in pieces:
            if piece not in self.words:
                self.words[piece] = self._piece(piece)
        return b"".join(map(self.words.__getitem__, pieces))

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if not self.by_word or not plain(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        words, memory = text.lower().split(), self.words
        try:
            joined = b"".join(map(memory.__getitem__, words))
        except KeyError:
            if len(memory) > self.memory_words:
                memory.clear()
            own = {w: memory[w] if w in memory else self._word(w) for w in set(words)}
            memory.update(own)
            joined = b"".join(map(own.__getitem__, words))
        return np.frombuffer(joined, "<u2").astype("<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# -------------------------------------------------------------------- planes


def to_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """The planes of a block from the lowest; planes above the largest id's highest bit are left out."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        return [octets[:, k].tobytes() for k in range(-(-top // 8))]
    bits = np.unpackbits(octets, axis=1, bitorder="little", count=None)
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(top)]


def from_planes(planes: list[bytes], n: int, kind: str = "bit") -> np.ndarray:
    octets = np.zeros((n, 4), np.uint8)
    if kind == "byte":
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, np.uint8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        for k, plane in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=n)
        octets = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").ravel()


class PlaneWriter:
    """Appends documents to one file; holds a block at a time and 17 bytes a document."""

    def __init__(self, out, block_ids: int = BLOCK_IDS, kind: str = "bit", level: int = 3):
        self.out, self.block_ids, self.kind = out, block_ids, kind
        self.press = zstandard.ZstdCompressor(level=level)
        self.pending, self.held, self.offset, self.index = [], 0, len(MAGIC), []
        self.doc_ids, self.lengths, self.n_ids = [], [], 0
        out.write(MAGIC)

    def _block(self, ids: np.ndarray) -> None:
        frames = [self.press.compress(p) for p in to_planes(ids, self.kind)]
        self.index.append([self.offset, len(ids), [len(f) for f in frames]])
        for frame in frames:
            self.out.write(frame)
            self.offset += len(frame)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            whole = np.concatenate(self.pending)
            cut = len(whole) // self.block_ids * self.block_ids
            for k in range(0, cut, self.block_ids):
                self._block(whole[k : k + self.block_ids])
            self.pending, self.held = [whole[cut:]], len(whole) - cut

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.pending))
        known = np.array([d is not None for d in self.doc_ids], np.uint8).tobytes()
        ids = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
        parts = [self.press.compress(x) for x in (
            json.dumps({"kind": self.kind, "block_ids": self.block_ids, "chunks": self.index}).encode(),
            known, ids, np.array(self.lengths, "<i8").tobytes(),
        )]
        for part in parts:
            self.out.write(part)
        self.out.write(struct.pack("<4Q", *map(len, parts)) + MAGIC)


class PlaneReader:
    """Random access to a file's blocks by its chunk index, and its documents."""

    def __init__(self, source):
        self.source, size = source, source.size()
        tail = 32 + len(MAGIC)
        source.seek(size - tail)
        end = source.read(tail)
        if end[32:] != MAGIC:
            raise ValueError("not a bit-plane file")
        sizes = struct.unpack("<4Q", end[:32])
        source.seek(size - tail - sum(sizes))
        self.press = zstandard.ZstdDecompressor()
        parts = [self.press.decompress(source.read(n)) for n in sizes]
        index = json.loads(parts[0])
        self.kind, self.block_ids, self.chunks = index["kind"], index["block_ids"], index["chunks"]
        known = np.frombuffer(parts[1], np.uint8)
        self.doc_ids = [d if k else None for d, k in zip(np.frombuffer(parts[2], "<i8").tolist(), known)]
        self.lengths = np.frombuffer(parts[3], "<i8")

    def block(self, k: int) -> np.ndarray:
        offset, n, sizes = self.chunks[k]
        self.source.seek(offset)
        return from_planes([self.press.decompress(self.source.read(s)) for s in sizes], n, self.kind)

    def documents(self):
        """(document id, ids of all documents of the file before it, its ids in pieces of at most a block)."""
        k, block, at_id, before = -1, np.empty(0, "<u4"), 0, 0
        for doc_id, length in zip(self.doc_ids, self.lengths.tolist()):
            pieces, need = [], length
            while need:
                if at_id == len(block):
                    k, at_id = k + 1, 0
                    block = self.block(k)
                take = min(need, len(block) - at_id)
                pieces.append(block[at_id : at_id + take])
                at_id, need = at_id + take, need - take
            yield doc_id, before, pieces
            before += length


# -------------------------------------------------------------------- frames

MANIFEST = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS, kind: str = "bit",
) -> pa.Table:
    """Encode and write; one manifest row per file (one per range of document ids).

    Texts are dealt by ranges of the document id before they are encoded, so
    the costly step runs once. The manifest has as many rows as there are ranges.
    """

    def write(batches):
        out, writer, path = None, None, None
        encode = encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for k, doc_id in enumerate(ids):
                if writer is None:
                    path = fresh(folder, f"ids-{TaskContext.get().partitionId():06d}")
                    store, where = at(path)
                    out = store.open_output_stream(where)
                    writer = PlaneWriter(out, block_ids, kind)
                writer.add(doc_id, np.append(encode(texts[k].as_py()), np.array([end_id], "<u4")))
        if writer is not None:
            writer.close()
            out.close()
            row = [[TaskContext.get().partitionId()], [path], [len(writer.doc_ids)], [writer.n_ids]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(row, MANIFEST)], schema=MANIFEST)

    ranged = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange("id")
    ranged = ranged.sortWithinPartitions("id", "text")
    return mapped(ranged, write, "part int, path string, n_docs long, n_ids long").toArrow().sort_by("part")


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_ids(spark: SparkSession, manifest: pa.Table) -> DataFrame:
    """What the files hold, one row per document: place among all ids, length and checksum."""
    before = np.concatenate([[0], np.cumsum(manifest["n_ids"].to_numpy())])[:-1].astype(np.int64)
    table = manifest.append_column("before", pa.array(before, pa.int64()))

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                store, where = at(path)
                rows = []
                with store.open_input_file(where) as source:
                    for doc_id, start, pieces in PlaneReader(source).documents():
                        crc, n = 0, 0
                        for piece in pieces:
                            crc, n = zlib.crc32(piece.astype("<u4").tobytes(), crc), n + len(piece)
                        rows.append((doc_id, base + start, n, crc))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), READ)], schema=READ)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), READ)], schema=READ)

    files = one_task_each(table, lambda t: spark.createDataFrame(t, "part int, path string, n_docs long, n_ids long, before long"))
    return mapped(files, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, **options) -> DataFrame:
    """Write ``docs`` as bit-plane files in the shared folder and return what reading them gives."""
    spark = docs.sparkSession
    return read_ids(spark, write_ids(docs, shared_dir(spark, "bitplane"), tokenizer, end_id, **options))
