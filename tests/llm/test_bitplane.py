"""Round trips of the file format and of whole texts against the tokenizer itself."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabloom.llm.bitplane import Encoder, PlaneReader, PlaneWriter, encode_documents, from_planes, to_planes
from tabloom.llm.queries import tokenizer_path


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("top", [1, 2, 255, 70_000, 2**32])
def test_planes_round_trip(kind, top):
    ids = np.random.default_rng(0).integers(0, top, 1000).astype("<u4")
    planes = to_planes(ids, kind)
    assert len(planes) == (int(ids.max()).bit_length() if kind == "bit" else -(-int(ids.max()).bit_length() // 8))
    assert (from_planes(planes, len(ids), kind) == ids).all()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_file_round_trip_and_random_access(kind):
    rng = np.random.default_rng(1)
    docs = [(None if k == 3 else k, rng.integers(0, 49_000, n).astype("<u4")) for k, n in enumerate([5, 0, 100, 1, 1000, 64, 63, 65, 0])]
    out = io.BytesIO()
    writer = PlaneWriter(out, block_ids=64, kind=kind)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    reader = PlaneReader(pa.BufferReader(out.getvalue()))
    whole = np.concatenate([ids for _, ids in docs])
    assert (reader.block(5) == whole[320:384]).all() and all(len(reader.block(k)) == 64 for k in range(len(reader.chunks) - 1))
    before = 0
    for (doc_id, start, pieces), (want, ids) in zip(reader.documents(), docs, strict=True):
        assert (doc_id, start) == (want, before) and (np.concatenate([*pieces, np.empty(0, "<u4")]) == ids).all()
        before += len(ids)


def test_remembered_words_give_the_tokenizers_ids():
    rng = random.Random(2)
    odd = ["'s", "'ll", "<|endoftext|>", "é", "É", "ß", "²", "\x85", "\xa0", "\x1c", "ﬁ", "é", "日本", "İ", "Σ", "​", "1", "a", "Z", "!!", " ", "\n", "don't", "_"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(1500)]
    plain = Tokenizer.from_file(tokenizer_path())
    encode = Encoder(tokenizer_path(), memory_words=50)
    for text in texts:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_documents_come_back_in_order(spark, docs_of):
    rows = [(9, "The end."), (1, None), (4, ""), (4, "same id"), (2, "x " * 40_000), (None, "no id"), (7, "The end."), (7, "The end.")]
    plain = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for options in ({}, {"block_ids": 100, "kind": "byte"}):
        got = encode_documents(docs_of(rows), tokenizer_path(), **options)
        assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert encode_documents(docs_of([]), tokenizer_path()).count() == 0
