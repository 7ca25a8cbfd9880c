import numpy as np
import pytest

from comptoir.llm import embeddings
from comptoir.llm.embeddings import encoded, fit_index, near_duplicates, near_pairs, smallest_reachable


def brute(rows, least=0.95):
    def usable(k, v):
        return k is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def length_one(v):
        v = np.array(v, float) / np.abs(v).max()
        return v / np.linalg.norm(v)

    unit = [length_one(v) if usable(k, v) else None for k, v in rows]
    part = list(range(len(rows)))
    count = [0] * len(rows)

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                part[find(i)] = find(j)
                count[i] += 1
                count[j] += 1
    first = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            first[find(i)] = min(k, first.get(find(i), k))
    return sorted(((k, count[i], first.get(find(i), k), k is None or k == first[find(i)]) for i, (k, _) in enumerate(rows)), key=repr)


def ran(spark, rows, **options):
    frame = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<double>, node long, v int")
    out = near_duplicates(frame, **options)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=repr)


def clustered(rng, groups, size=24, noise=0.05):
    out = []
    for _ in range(groups):
        base = rng.normal(size=size)
        for _ in range(int(rng.choice([1, 1, 2, 5, 30]))):
            out.append((base + rng.normal(size=size) * noise * rng.random()) * rng.choice([1, 1, 3]))
    return [v.astype(np.float32).astype(float).tolist() for v in out]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(embeddings, "LIST_ROWS", 20)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "PAIRS", 64)


def test_recall_and_precision(spark, small):
    rng = np.random.default_rng(3)
    vectors = clustered(rng, 60)
    rows = [(i * 13 % 1009, v) for i, v in enumerate(vectors)]
    got, expected = ran(spark, rows), brute(rows)
    assert len(got) == len(expected)
    found, true = sum(r[1] for r in got), sum(r[1] for r in expected)
    assert 0.95 * true <= found <= true
    assert all(a[1] <= b[1] for a, b in zip(got, expected, strict=True))
    assert ran(spark, rows, probes=1000) == expected  # every list probed: nothing is lost


def test_edges(spark, small):
    rng = np.random.default_rng(5)
    one, other = rng.normal(size=8).tolist(), rng.normal(size=8).tolist()
    rows = [(1, None), (2, []), (3, [0.0] * 8), (4, [1.0, None]), (5, [float("nan")] * 8), (6, [float("inf")] * 8), (None, one),
            (7, one), (8, [2 * x for x in one]), (9, [1e-200 * x for x in one]), (10, [1e200 * x for x in one]), (7, other), (11, [-x for x in one]),
            (12, [1.0, 2.0]), (13, [1.0, 2.01]), (14, [-0.0, 1.0]), (15, [0.0, 1.0])]
    rows += [(100 + i, other) for i in range(40)]  # a third of all rows and more are one vector
    assert ran(spark, rows) == brute(rows)
    assert ran(spark, []) == []
    assert ran(spark, [(1, None), (None, None)]) == brute([(1, None), (None, None)])


def test_quantised_distances_lose_no_pair():
    rng = np.random.default_rng(1)
    x = np.array(clustered(rng, 80), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = fit_index(x, 4)
    near, codes, missed = encoded(x, index, 2)
    for at in range(4):
        own = np.flatnonzero(near[:, 0] == at)
        a, b = near_pairs(x, x[own], codes[own], missed[own], index, at, 0.95)
        exact = np.argwhere(x @ x[own].T >= 0.95)
        assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(map(tuple, exact.tolist()))


def test_smallest_reachable():
    assert smallest_reachable(7, np.array([6, 5, 4, 1]), np.array([5, 4, 3, 2])).tolist() == [0, 1, 1, 3, 3, 3, 3]


def test_recall_of_the_routing_with_the_most_lists():
    """Pairs of cosine 0.95 to 0.97 among vectors without clusters, the hardest case: one of both probes the other's list."""
    rng, n = np.random.default_rng(0), 12_000
    base, side = rng.normal(size=(embeddings.SAMPLE, 64)), rng.normal(size=(n, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    index, base = fit_index(base, embeddings.LISTS), base[:n]
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(.95, .97, (n, 1))
    a, b = (encoded(x, index, embeddings.PROBES)[0] for x in (base, base * cosine + side * np.sqrt(1 - cosine * cosine)))
    assert ((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)).mean() > 0.99


def test_query_equals_brute_force(spark, sf_dir):
    from comptoir.llm.queries import REGISTRY

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    out = sorted(map(tuple, REGISTRY["op7_embeddings"](spark, sf_dir).collect()), key=repr)
    assert out == brute(rows)
