import random
import re

import numpy as np
import pyarrow as pa
import pytest

from comptoir.llm import jaccard, words
from comptoir.llm.components import components
from comptoir.llm.jaccard import Scheme, join, linked, parities, parity_bits, sets_of, signatures

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                part[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(s), least.get(find(i)) if any(find(j) == find(i) for j in range(len(rows)) if j != i) else key)
            for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))]


def edited(rng, base, edits):
    out = base.split(" ")
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(rng, groups=25, line="one common line that very many of the documents have in the middle"):
    rows = []
    for _ in range(groups):
        n = rng.choice([1, 2, 4, 5, 6, 8, 12, 20, 40, 80, 150, 400])
        base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
        if rng.random() < .5:
            base = f"{base} {line} {base[:30]}"
        for _ in range(rng.choice([1, 2, 3, 5, 12])):
            base = edited(rng, base, rng.choice([0, 0, 1, max(1, n // 50), max(1, n // 25)])) if rng.random() < .8 else base.upper()
            rows.append(base)
    rng.shuffle(rows)
    return rows


def ran(spark, rows, **options):
    frame = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, node int, component_id int")
    return sorted(map(tuple, join(frame, **options).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(corpus(rng))]
    assert ran(spark, rows) == sorted(brute(rows), key=repr)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, ""), (2, None), (3, " \n\t"), (4, "a"), (5, "A"), (6, "a b c d"), (7, "a b c d e"), (8, "a\nB c\td"),
            (9, long), (10, long + " end"), (None, "a"), (5, "a"), (5, "x y z"), (None, "alone here"), (11, "é É"), (12, "é É"),
            (13, "É É"), (14, "x " * 500), (15, "x " * 9)]
    assert ran(spark, rows) == sorted(brute(rows), key=repr)
    assert ran(spark, []) == []
    assert ran(spark, [(1, None)]) == [(1, 0, 1)]


def test_groups_of_different_documents(spark, monkeypatch):
    """Documents that share little more than a signature, in groups beyond the size for pairs."""
    monkeypatch.setattr(jaccard, "SMALL_GROUP", 2)
    monkeypatch.setattr(jaccard, "PART_ROWS", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rng = random.Random(9)
    words_ = [f"v{i}" for i in range(14)]
    rows = [(i, " ".join(rng.choices(words_, k=rng.randint(4, 9)))) for i in range(60)]
    base = [f"w{i}" for i in range(40)]
    for i in range(60, 100):  # a chain: neighbours are alike, ends are not
        base[(i * 3) % 40] = f"x{i}"
        rows.append((i, " ".join(base)))
    assert ran(spark, rows) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    scheme = Scheme(percent)
    for _ in range(3000):
        n = int(rng.integers(1, rng.choice([6, 20, 100, 400])))
        a = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        drop = rng.random(len(a)) < rng.choice([0, .02, .1, .2])
        b = np.unique(np.concatenate([a[~drop], rng.integers(0, 1 << 48, int(rng.integers(0, 1 + n // 6)), dtype=np.uint64)]))
        if not len(b) or not linked(a, b, percent):
            continue
        sig, who = signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), scheme)
        assert set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())
        bits = [np.frombuffer(parities(x, parity_bits(scheme, len(x))), np.uint8)[None, :] for x in (a, b)]
        least = min(x.shape[1] for x in bits) * 8
        apart = sum(np.bitwise_count(jaccard._folded(bits[0], least) ^ jaccard._folded(bits[1], least)).ravel().tolist())
        assert apart * (100 + percent) <= (len(a) + len(b)) * (100 - percent)


def test_sets():
    texts = ["a b c d e f", "A B c d e f a b c d e", None, "", "x y", "one"]
    for limit in (4, 1 << 20):
        got = []
        for _, _, data, offsets in words.chunks(pa.array(texts), limit):
            features, sizes = sets_of(data, offsets, words.Hasher())
            got += [frozenset(x.tolist()) for x in np.split(features, np.cumsum(sizes)[:-1])]
        assert [len(x) for x in got] == [len(shingles(t)) for t in texts]
        assert got[0] < got[1]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    links += [(999, x) for x in range(400, 450)] + [(5, 5), (7000, 7000)]
    part = {x: x for p in links for x in p}
    for _ in part:
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {k: v for k, v in part.items() if any(k in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_representatives_keep_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 7, 8, 9), (2, text, 7, 8, 9), (3, "other", 7, 8, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int, __node int, component int").coalesce(1)
    out = jaccard.representatives(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[2]]
