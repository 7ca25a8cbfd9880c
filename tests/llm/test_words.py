"""Words whose polynomial fingerprints modulo a power of two are equal, whatever the base, are told apart everywhere."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from comptoir.llm import jaccard, packing, passages, sentencepieces, words


def thue_morse(n):
    word = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def spans_of(texts):
    data, offsets = words.buffer(pa.array(texts, pa.string()))
    return data, offsets[:-1], offsets[1:]


@pytest.mark.parametrize("n", [8, 16, 32, 64, 1024, 2048, 4096])
def test_fingerprints(n):
    a, b = words.Hasher().spans(*spans_of(list(thue_morse(n))))
    assert a != b
    first, inverse = words.distinct(*spans_of([*thue_morse(n), *thue_morse(n)]))
    assert len(first) == 2 and inverse[0] == inverse[2] != inverse[1] == inverse[3]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab\0é", max_size=40), max_size=20))
def test_distinct(texts):
    first, inverse = words.distinct(*spans_of(texts))
    assert [texts[first[k]] for k in inverse] == texts
    assert len({texts[i] for i in first}) == len(first)
    keys = words.Hasher().spans(*spans_of(texts))
    assert len(set(keys.tolist())) == len(set(texts))


def test_distinct_where_fingerprints_collide(monkeypatch):
    monkeypatch.setattr(words.Hasher, "_spans", lambda self, data, at, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["wordword1", "wordword2", "x" * 40, "y" * 40, "wordword1", "x" * 40]
    first, inverse = words.distinct(*spans_of(texts))
    assert [texts[first[k]] for k in inverse] == texts and len(first) == 4


def test_short_spans_do_not_collide_by_length():
    texts = ["a" + "\0" * k for k in range(12)]
    assert len(set(words.Hasher().spans(*spans_of(texts)).tolist())) == 12


def test_memo_over_generations():
    memo, asked = words.Memo(limit=20_000), []

    def encode(strings):
        asked.extend(strings)
        return [np.frombuffer(s.encode(), np.uint8).astype(np.uint32) for s in strings]

    for k in range(200):
        texts = ["often", *(f"w{k}-{i}" for i in range(20)), ""]
        ids, count = memo.look_up(*spans_of(texts), encode)
        assert [bytes(x.astype(np.uint8)).decode() for x in np.split(ids, np.cumsum(count)[:-1])] == texts
    assert asked.count("often") == 1
    assert memo.young.held + memo.old.held < 40_000


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators(spark, n):
    a, b = thue_morse(n)
    rows = [(0, a, 1), (1, b, 1), (2, f"x {a} y", 1), (3, f"x {b} y", 1)]
    tail = " ".join(f"w{i}" for i in range(14))
    rows += [(4, f"{a} {tail}", 1), (5, f"{b} {tail}", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int").coalesce(1)
    out = {r.doc_id: r for r in jaccard.join(docs).collect()}
    assert [(out[i].n_shingles, out[i].component_id) for i in range(4)] == [(1, i) for i in range(4)]
    cut = {r.doc_id: r for r in passages.deduplicated(docs).collect()}
    assert [cut[i].n_removed for i in range(6)] == [0, 0, 0, 0, 0, 14]
    assert cut[5].kept == b
    full = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    pieces = packing.pack(docs, "/opt/tokenizers/word_bpe_49k.json").orderBy("doc_id", "start").collect()
    for k, own in itertools.groupby(pieces, key=lambda r: r.doc_id):
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist()
        assert ids == [*full.encode(rows[k][1], add_special_tokens=False).ids, 2]
    path = "/opt/tokenizers/piece_bpe_32k.model"
    encoded = sentencepieces.encode(docs, path)
    assert encoded.where("round_trip and n_differing = 0").count() == len(rows)
