import math

import numpy as np
from pyspark.sql import functions as F

from comptoir.llm import topk
from comptoir.llm.queries import ORACLE, REGISTRY
from comptoir.llm.topk import finite, top_k, whole_weights

SCHEMA = "vec_id long, embedding array<float>, score long, a int"


def brute(rows, k, is_query=lambda i: i % 20 == 0):
    whole = [(r[0], [math.floor(64 * float(np.float32(x))) for x in r[1]]) for r in rows
             if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for q in sorted({i for i, _ in whole if is_query(i)}):
        scores = [(-sum(a * b for a, b in zip(w, v)), c) for i, w in whole if i == q for c, v in whole if c != q]
        out += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(sorted(scores)[:k])]
    return out


def ran(spark, rows, k):
    frame = spark.createDataFrame(rows, SCHEMA).where(finite(F.col("embedding"))).select(
        "*", whole_weights(F.col("embedding")).alias("weights"))
    return [tuple(r) for r in top_k(frame, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect()]


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, .2, rng.integers(0, 9)).tolist(), 1, 2) for i in range(60)]
    rows += [(i, [0.25] * 8, 1, 2) for i in range(60, 140)]  # a third of all rows are one vector: ties
    rows += [(200, None, 0, 0), (201, [1.0, None], 0, 0), (220, [float("nan")], 0, 0), (240, [float("inf")], 0, 0),
             (None, [1.0], 0, 0), (260, [], 0, 0), (280, [0.0, 0.0], 0, 0), (40, [0.5] * 4, 0, 0), (7, [0.5], 0, 0),
             (7, [0.5], 0, 0)]
    assert ran(spark, rows, 5) == brute(rows, 5)
    assert ran(spark, rows, 500) == brute(rows, 500)


def test_empty_and_alone(spark):
    assert ran(spark, [], 5) == []
    assert ran(spark, [(20, [1.0], 0, 0)], 5) == []
    assert ran(spark, [(20, [1.0], 0, 0), (3, [-1.0], 0, 0)], 5) == [(20, 1, 3, -64 * 64)]


def test_query_has_sql():
    assert set(ORACLE) <= set(REGISTRY)
