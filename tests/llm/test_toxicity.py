import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from comptoir.llm import toxicity
from comptoir.llm.queries import REGISTRY

INSULTS = ("idiot", "moron", "worthless", "pathetic")
RNG = random.Random(3)
SYLLABLES = ("the", "on", "re", "ing", "er", "and", "ti", "ou", "sh", "le", "en", "ha")


def sentence(n):
    return " ".join("".join(RNG.choices(SYLLABLES, k=RNG.randint(1, 4))) for _ in range(n)) + "."


def text(toxic, n=60):
    parts = sentence(n).split(" ")
    for _ in range(2 if toxic else 0):
        parts.insert(RNG.randrange(len(parts)), RNG.choice(INSULTS))
    return " ".join(parts)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    return (spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string"),
            spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int"), rows)


@pytest.fixture(scope="module")
def model(corpus):
    docs, labels, _ = corpus
    return toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)


def test_kernel_equals_its_definition():
    strings = [b"idiot", b"i.d.i-o-t", b"idxiot", b"banana", "él".encode() * 3, b"ab", b"aaaaaaa"]

    def features(s):
        out, norm = {}, 0.0
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    symbols = tuple(int(toxicity.SYMBOL[s[x]]) for x in (i, j, k))
                    if all(symbols):
                        w = toxicity.DECAY ** (k - i + 1)
                        out[symbols] = out.get(symbols, 0) + w
                        norm += w * w
        return {k: v / norm ** .5 for k, v in out.items()}

    expected = [[sum(v * features(b).get(k, 0) for k, v in features(a).items()) for b in strings] for a in strings]
    assert toxicity.similarities(strings, strings) == pytest.approx(np.array(expected), abs=1e-9)


def test_table_equals_the_machine(model):
    words = [b"idiot", b"theonre", b"worthless,"]
    who, code, weight = toxicity.occurrences(words)
    expected = np.bincount(who, weight * model.table[code], 3) + model.bias
    for w, e in zip(words, expected, strict=True):
        got, at = toxicity.document_decisions(pa.array([w.decode()]), model)
        assert got[0] == pytest.approx(e, abs=1e-4) and at == [(0, len(w))]


def test_held_out(spark, corpus, model):
    docs, _, rows = corpus
    scored = toxicity.score(docs, model, where="at")
    assert scored.columns == ["doc_id", "text", "score", "at"]
    got = {r.doc_id: r for r in scored.collect()}
    held = [(got[i].score >= 0.3, bool(y)) for i, _, y in rows if i % 5 == 0]
    assert np.mean([a == b for a, b in held]) >= 0.97
    for i, t, y in rows:
        if y and got[i].score >= 0.3:
            assert t.encode()[got[i].at.start:got[i].at.end].decode().strip(".,") in INSULTS


@pytest.mark.parametrize("insult", ["i.d.i.o.t", "i d i o t", "idiiot", "idi*ot", "IDIOT", "m-o-r-o-n", "morxon", "wor.thless"])
def test_disguised_insults(spark, model, insult):
    clean = sentence(40)
    docs = spark.createDataFrame([(1, clean), (2, f"{clean} {insult} {clean}")], "doc_id long, text string")
    low, high = (r.score for r in toxicity.score(docs, model).orderBy("doc_id").collect())
    assert high >= 0.3 > low


def test_edges(spark, corpus, model):
    schema = "doc_id long, text string, `a.b` int"
    long = (sentence(2000) + " ") * 10
    docs = spark.createDataFrame([(1, "", 1), (None, None, 2), (1, "  \n", 3), (4, long + "moron", 4), (5, "\0é日", 5),
                                  (6, "x" * 5000, 6)], schema)
    rows = toxicity.score(docs, model).orderBy("`a.b`").collect()
    assert [r["a.b"] for r in rows] == [1, 2, 3, 4, 5, 6] and all(0 <= r.score <= 1 for r in rows)
    assert rows[0].score == rows[1].score == rows[2].score < 0.3 <= rows[3].score
    assert toxicity.score(docs.limit(0), model).count() == 0
    no_labels = spark.createDataFrame([(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, no_labels, F.lit(True)) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_query(spark, sf_dir):
    rows = REGISTRY["op2_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


@pytest.mark.parametrize("insult", ["i--d--i--o--t", "m...o...r...o...n", "i. d. i. o. t", "i  d  i  o  t", "i - d - i - o - t"])
def test_wide_gaps(spark, model, insult):
    clean = sentence(40)
    docs = spark.createDataFrame([(1, clean), (2, f"{clean} {insult} {clean}")], "doc_id long, text string")
    low, high = (r.score for r in toxicity.score(docs, model).orderBy("doc_id").collect())
    assert high >= 0.3 > low


def test_spaced_letters_of_several_bytes_are_one_unit():
    for text in ("é t é", "i. d. é", "i - d"):
        data = np.frombuffer(text.encode(), np.uint8)
        begin, end, _, unit = toxicity.units(data, np.array([0, len(data)]))
        assert begin.tolist() == [0] and end.tolist() == [len(data)] and set(unit.tolist()) == {0}
    data = np.frombuffer(b"a bc 1 2 d", np.uint8)
    assert len(toxicity.units(data, np.array([0, len(data)]))[0]) == 5
