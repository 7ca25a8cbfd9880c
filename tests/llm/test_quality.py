import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from comptoir.llm import quality
from comptoir.llm.queries import REGISTRY

RNG = random.Random(8)
SYLLABLES = ("the", "on", "re", "ing", "er", "and", "ti", "ou", "sh", "le", "en", "ha")


def prose(n=60):
    return " ".join("".join(RNG.choices(SYLLABLES, k=RNG.randint(1, 4))) for _ in range(n)).capitalize() + "."


def junk(i):
    whole = prose()
    return [whole.upper().replace(" ", "!! "), " ".join([whole.split()[0]] * 60), whole.replace(" ", "*** "),
            whole.replace(" ", " | ")][i % 4]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, junk(i // 3) if i % 3 == 0 else prose(RNG.randint(20, 90)), int(i % 3 > 0)) for i in range(600)]
    return (spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, words string"),
            spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int"), rows)


@pytest.fixture(scope="module")
def model(corpus):
    return quality.fit(corpus[0], corpus[1], F.col("doc_id") % 5 != 0)


def test_statistics():
    texts = ["", None, "The the Cat.\nthe cat |\nthe cat |", "é 12 ***", " \n "]
    rows = [dict(zip(quality.STATISTICS, r, strict=True)) for r in quality.statistics(pa.array(texts))]
    assert not any(rows[0].values()) and not any(rows[1].values()) and not any(rows[4].values())
    r = rows[2]
    assert (r["words"], r["lines"], r["bars"]) == (9, 3, 2 / 9)
    assert r["distinct"] == 4 / 9 and r["top_word"] == 4 / 9  # the, cat., cat, |
    assert r["repeats"] == 1 / 9 and r["equal_lines"] == pytest.approx(1 / 3) and r["marked_words"] == 2 / 9
    assert rows[3]["other"] == 2 / 7 and rows[3]["digits"] == 2 / 7 and rows[3]["marks"] == 3 / 7


def test_whole_texts_in_chunks(monkeypatch):
    texts = [prose(40) for _ in range(20)] + [prose(4000)]
    once = quality.statistics(pa.array(texts))
    monkeypatch.setattr(quality.words.chunks, "__defaults__", (300,))
    assert quality.statistics(pa.array(texts)) == pytest.approx(once)


def test_held_out(corpus, model):
    got = {r.doc_id: r.score for r in quality.score(corpus[0], model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in corpus[2] if i % 5 == 0]) >= 0.97


def test_column_equals_the_rules(spark, corpus, model):
    assert 0 < len(model.rules) < 150
    assert all(1 <= len(r.conditions) <= quality.DEPTH for r in model.rules)
    rows = quality.score(corpus[0], model).limit(50).collect()
    for r in rows:
        x = [r[name] for name in quality.STATISTICS]
        total = model.offset + sum(rule.weight for rule in model.rules
                                   if all(low <= x[at] < high for at, low, high in rule.conditions))
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_lasso_thins():
    rng = np.random.default_rng(0)
    x = (rng.random((400, 30)) < 0.5).astype(float)
    y = (x[:, 3] + 0.1 * rng.random(400) > 0.5).astype(float)
    w = quality.lasso(x, y, np.ones(400), 0.02)
    assert np.abs(w[:-1]).argmax() == 3 and (w[:-1] != 0).sum() < 8


def test_edges(spark, corpus, model):
    docs = spark.createDataFrame([(1, "", 1), (None, None, 2), (1, prose(30000), 3), (4, "\0é日", 4)],
                                 "doc_id long, text string, score int")
    rows = quality.score(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert {c for c in quality.score(docs, model).columns if c == "score"} == {"score"}
    assert quality.score(docs.limit(0), model).count() == 0
    one_kind = corpus[1].where("quality = 1")
    assert quality.fit(corpus[0], one_kind, F.lit(True)) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}


def test_query(spark, sf_dir):
    rows = REGISTRY["op3_quality"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
