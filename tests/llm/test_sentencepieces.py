import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from comptoir.llm import words
from comptoir.llm.queries import REGISTRY
from comptoir.llm.sentencepieces import UNIGRAM, Codec, decode, encode, fields, parse, rebuild

PATH = "/opt/tokenizers/piece_bpe_32k.model"
DATA = open(PATH, "rb").read()
REFERENCE = sentencepiece.SentencePieceProcessor(model_proto=DATA)
TEXTS = ["", None, "Hello  world", " lead", "trail  ", "\n\t x", "▁mark ▁▁x", "été 日本 🙂 \0", "aaaaaaa aaaa",
         "<s> </s> <unk> <0x41>", "   ", "word " * 4000, "x" * 3000]


def unigram_model() -> bytes:
    """The same pieces as a unigram model: type 1, and the longer the likelier."""
    import struct

    def field(number, wire, payload):
        return bytes([number << 3 | wire]) + payload

    def block(number, payload):
        size, out = len(payload), b""
        while size > 127:
            out, size = out + bytes([size & 127 | 128]), size >> 7
        return bytes([number << 3 | 2]) + out + bytes([size]) + payload

    out = b""
    for piece, _, kind in parse(DATA).pieces:
        score = -12 + 1.1 * len(piece)
        out += block(1, block(1, piece.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))
    out += block(2, field(3, 0, b"\x01") + bytes([35 << 3 & 127 | 128, 35 << 3 >> 7, 1]))
    return out + block(3, field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01"))


@pytest.fixture(scope="module")
def codec():
    return Codec(DATA)


def ids_of(codec, texts, limit=64):
    out = []
    for _, _, data, offsets in words.chunks(pa.array(texts, pa.string()), limit):
        ids, count = codec.encode(data, offsets)
        out += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    return out


def test_parse():
    model = parse(DATA)
    assert len(model.pieces) == REFERENCE.get_piece_size() and model.byte_fallback and model.unknown == REFERENCE.unk_id()
    assert all(p == REFERENCE.id_to_piece(i) and s == REFERENCE.get_score(i) for i, (p, s, _) in enumerate(model.pieces))
    assert list(fields(b"\x08\x96\x01")) == [(1, 150)]


def test_rebuilt_whole_texts(codec):
    texts = [t for t in TEXTS if t]
    got = rebuild(codec.model).encode_batch(texts, add_special_tokens=False)
    assert [x.ids for x in got] == REFERENCE.encode(texts)
    for x, ids in zip(got, REFERENCE.encode(texts), strict=True):
        if "▁" not in REFERENCE.decode(ids):
            assert rebuild(codec.model).decode(x.ids, skip_special_tokens=False) == REFERENCE.decode(ids)


def test_unigram():
    data = unigram_model()
    codec, reference = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert codec.model.kind == UNIGRAM
    texts = ["Hello world, the quick brown fox", "été 日本 🙂", "aaaaaaa"]
    assert ids_of(codec, texts) == reference.encode(texts)
    assert codec.differing == 0


@given(st.lists(st.text(alphabet=st.sampled_from(list("ab the▁ing é日\n.1")), max_size=25), min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_words_equal_the_library(codec, texts):
    assert ids_of(codec, texts) == REFERENCE.encode(texts)


def test_parity(codec, spark, sf_dir):
    """The rebuilt tokenizer itself, before any repair."""
    fresh = Codec(DATA)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert ids_of(fresh, texts, 1 << 20) == REFERENCE.encode(texts)
    assert fresh.checked > 10000 and fresh.differing == 0


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)] + [(None, "x", 5), (2, "x", 5)],
                                 "doc_id long, text string, ids int")
    out = encode(docs, PATH)
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        if r.doc_id is not None and not (r.doc_id == 2 and r.n_ids == len(REFERENCE.encode("x"))):
            expected = REFERENCE.encode(TEXTS[r.doc_id] or "")
            assert np.frombuffer(r.ids, "<u4").tolist() == expected and r.n_ids == len(expected)
            assert r.round_trip == ("▁" not in (TEXTS[r.doc_id] or ""))  # the marker itself reads as a space
    back = {r.doc_id: r.text for r in decode(out.where("doc_id != 2"), PATH).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(TEXTS) if i != 2)
    assert encode(docs.limit(0), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, b"\x00\x00\x00\x00")], "doc_id long, ids binary")
    assert {r.doc_id: r.text for r in decode(nothing, PATH).collect()} == {1: None, 2: REFERENCE.decode([0])}


def test_query(spark, sf_dir):
    rows = {r.doc_id: r for r in REGISTRY["op6_sentencepieces"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = REFERENCE.encode(r.text or "")
        got = rows[r.doc_id]
        assert (got.n_ids, got.ids_crc32, got.round_trip) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)
