import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from comptoir.llm import negatives
from comptoir.llm.negatives import NO_CEILING, NO_FLOOR, index, mine, search
from comptoir.llm.queries import ORACLE, REGISTRY
from comptoir.llm.topk import finite, whole_weights

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score string, n int"


def brute(rows, every=10):
    """All pairs, by the definition."""
    whole = [(r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]], r[2]) for r in rows
             if r[0] is not None and r[1] is not None and r[2] is not None
             and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for a, w, label in whole:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(w, v)), i, c) for i, v, c in whole if i != a)
        for s, positive, _ in [x for x in scored if x[2] == label][:5]:
            band = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, positive, rank + 1, i, -s, -n) for rank, (n, i, _) in enumerate(band)]
    return sorted(out)


def ran(spark, rows, every=10):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).where(finite(F.col("embedding"))).select(
        "vec_id", "label", "id", "score", "n", whole_weights(F.col("embedding"), 256.0).alias("weights"))
    out = mine(frame, F.col("vec_id") % every == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture
def small(monkeypatch):
    for name, value in (("BLOCK", 40), ("ASKED", 4), ("BUCKET", 8)):
        monkeypatch.setattr(negatives, name, value)


def row(i, vector, label):
    return i, vector, label, 1, "x", 2


def test_clusters_ties_and_hot_label(spark, small):
    rng = np.random.default_rng(3)
    centers = rng.normal(0, .4, (6, 12))
    rows = [row(i, (centers[i % 6] + rng.normal(0, .1, 12)).tolist(), int(rng.integers(0, 4)) if i % 3 else 7) for i in range(200)]
    rows += [row(i, [0.5] * 12, i % 2) for i in range(200, 300)]  # a third of all rows are one vector
    assert ran(spark, rows) == brute(rows)


def test_lengths_zero_and_opposite(spark, small):
    rng = np.random.default_rng(4)
    rows = [row(i, (rng.normal(0, 1, 5) * 10.0 ** rng.integers(-2, 3)).tolist(), i % 3) for i in range(60)]
    rows += [row(i, rng.normal(0, 1, rng.integers(0, 9)).tolist(), i % 3) for i in range(60, 90)]
    rows += [row(90, [0.0] * 5, 0), row(91, [], 1), row(92, [], 0), row(100, [-1.0] * 5, 5), row(101, [1.0] * 5, 5)]
    found = ran(spark, rows)
    assert found == [x for x in brute_filled(rows)]
    assert any(x[4] == 0 for x in found)


def brute_filled(rows):
    longest = max(len(r[1]) for r in rows)
    return brute([(r[0], list(r[1]) + [0.0] * (longest - len(r[1])), *r[2:]) for r in rows])


def test_rows_that_take_no_part_and_repeats(spark, small):
    good = [row(i, [math.cos(i / 9), math.sin(i / 9)], i % 2) for i in range(25)]
    bad = [row(10, None, 1), row(20, [1.0, None], 1), row(30, [float("nan"), 1.0], 1), row(40, [float("inf"), 1.0], 1),
           row(None, [1.0, 0.0], 1), row(50, [1.0, 0.0], None)]
    repeats = [row(3, [1.0, 0.1], 1), row(3, [1.0, 0.1], 1), row(10, [0.9, 0.3], 0)]
    assert ran(spark, good + bad + repeats) == brute(good + bad + repeats)


def test_empty_and_alone(spark):
    assert ran(spark, []) == []
    assert ran(spark, [row(10, [1.0], 0)]) == []
    assert ran(spark, [row(10, [1.0], 0), row(11, [1.0], 0), row(12, [0.9], 1)]) == [(10, 11, 1, 12, 65536, 230 * 256)]


def test_pruning_prunes():
    """Less than half of the vectors are verified once a floor is known."""
    rng = np.random.default_rng(1)


    vectors = rng.normal(0, 256, (4000, 16)).astype(int)
    table = pa.table({"id": np.arange(4000), "label": np.zeros(4000, int), "weights": pa.array(list(vectors))})
    buckets = index(table)
    asked = vectors[17]
    scores = vectors @ asked
    fifth = int(np.sort(scores)[-6])
    verified = []
    for bucket in buckets[0]:
        own = bucket.feasible
        bucket.feasible = lambda *a, own=own: verified.append(len(x := own(*a))) or x
    (best,) = search(buckets, asked, 17, 0, False, [(fifth, NO_CEILING)], 5)
    order = [i for i in np.lexsort((np.arange(4000), -scores)) if i != 17][:5]
    assert best[1].tolist() == order
    assert sum(verified) < 2000  # half of them
    (best,) = search(buckets, asked, 17, 0, False, [(NO_FLOOR, NO_CEILING)], 5)
    assert best[1].tolist() == order


def test_large_whole_numbers(spark):
    frame = spark.createDataFrame([(0, 1, [1 << 30, 3]), (1, 1, [1 << 30, 5]), (2, 2, [1 << 30, 4]), (3, 2, [1 << 30, 6])],
                                  "vec_id long, label int, weights array<long>")
    out = [tuple(r) for r in mine(frame, F.col("vec_id") == 0).collect()]
    assert out == [(0, 1, 1, 2, (1 << 60) + 15, (1 << 60) + 12)]


def test_query_equals_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    out = REGISTRY["op11_negatives"](spark, sf_dir)
    assert sorted(map(tuple, out.collect())) == sorted(duckdb.sql(
        f"SELECT {', '.join(out.columns)} FROM ({ORACLE['op11_negatives']})").fetchall())
