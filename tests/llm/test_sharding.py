import zlib
from collections import Counter

import numpy as np
import pytest

from comptoir.llm.queries import REGISTRY
from comptoir.llm.sharding import communication_matrix, hypergeometric, shuffled


def test_draws_are_hypergeometric():
    rng = np.random.default_rng(1)
    drawn = Counter(hypergeometric(rng, 5, 7, 4) for _ in range(20000))
    from math import comb
    for x in range(5):
        assert drawn[x] / 20000 == pytest.approx(comb(5, x) * comb(7, 4 - x) / comb(12, 4), abs=0.012)
    big = [hypergeometric(rng, 3 * 10**11, 7 * 10**11, 10**6) for _ in range(400)]
    assert np.mean(big) == pytest.approx(300000, rel=1e-3)
    assert np.std(big) == pytest.approx(458.3, rel=0.15)


@pytest.mark.parametrize("rows", [[], [0], [1], [5, 0, 3], [100, 1, 57]])
def test_matrix_sums(rows):
    sizes = [sum(rows) // 8 + (i < sum(rows) % 8) for i in range(8)]
    matrix = communication_matrix(rows, sizes, 3)
    assert matrix.sum(axis=1).tolist() == rows and (not rows or matrix.sum(axis=0).tolist() == sizes)
    assert (matrix >= 0).all()


def check(rows, n, shards=8):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == n
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_sizes(spark, n):
    frame = spark.range(n).selectExpr("id % 3 as id", "null as shard", "'x' as slot", "1 as draw", "id as `a.b`").repartition(5)
    out = shuffled(frame, 8)
    assert out.columns == ["id", "draw", "a.b", "shard", "slot"]
    check(out.collect(), n)


def test_blocks_and_uniformity(spark, monkeypatch):
    from comptoir.llm import sharding
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 8)
    seen = Counter()
    for seed in range(12):
        rows = shuffled(spark.range(0, 400, 1, 4), 4, seed).collect()
        check(rows, 400, 4)
        seen.update((r.id // 100, r.shard, r.slot // 50) for r in rows)
    expected = 12 * 400 / (4 * 4 * 2)
    assert sum((n - expected) ** 2 / expected for n in seen.values()) < 80  # 31 degrees of freedom


def test_query(spark, sf_dir):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = REGISTRY["op10_sharding"](spark, sf_dir).collect()
    check(rows, len(texts))
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "rows", None)
