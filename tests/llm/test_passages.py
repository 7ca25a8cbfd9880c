import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from comptoir.llm import passages
from comptoir.llm.passages import deduplicated, hits


def brute(rows, width=13):
    listed = [(k if k is not None else passages.NO_KEY, re.findall("[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    least = {}
    for k, w in listed:
        for i in range(len(w) - width + 1):
            g = tuple(w[i:i + width])
            least[g] = min(k, least.get(g, k))
    out = []
    for (key, _), (k, w) in zip(rows, listed, strict=True):
        gone = {j for i in range(len(w) - width + 1) if least[tuple(w[i:i + width])] < k for j in range(i, i + width)}
        out.append((key, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def ran(spark, rows, **options):
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, node int, kept string")
    out = deduplicated(frame, **options)
    assert out.columns == ["doc_id", "text", "node", "n_words", "n_removed", "kept"]
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()), key=repr)


def prose(rng, n, vocabulary=10**6):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize(("seed", "shard"), [(1, 400_000), (2, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, shard):
    monkeypatch.setattr(passages, "SHARD_WORDS", shard)
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (12, 13, 14, 20, 60, 200)]
    rows = []
    for i in range(120):
        parts = [prose(rng, rng.choice([0, 1, 5, 30]))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            parts += [p[a:] if rng.random() < .3 else p, prose(rng, rng.choice([0, 1, 8]))]
        if rng.random() < .2:
            parts.append(rng.choices(["a", "b"], k=40))
        rows.append((i * 11 % 127 + 2**40, rng.choice([" ", "\n", " \t"]).join(w for p in parts for w in p)))
    rows += [(500 + 2**40 - i, rows[3][1]) for i in range(20)] + [(-5, rows[10][1])]
    assert ran(spark, rows) == brute(rows)


def test_edges(spark):
    rng = random.Random(4)
    thirteen = " ".join(prose(rng, 13))
    long = " ".join(prose(rng, 20000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "few words"), (5, "few words"), (6, thirteen), (7, thirteen), (7, thirteen + " x"),
            (8, "y " + thirteen), (None, thirteen), (None, "alone " * 20), (9, long), (10, long), (10, "pre " + long),
            (11, "same " * 30), (12, "same " * 300), (13, "é " * 13), (14, "É " * 13)]
    assert ran(spark, rows) == brute(rows)
    assert ran(spark, []) == []
    assert ran(spark, rows, width=5) == brute(rows, 5)


def in_bytes(*texts):
    return [" ".join(t).encode() for t in texts]


def test_automaton_marks_only_what_came_before():
    a, b = ["a"] * 3 + ["x", "y", "z"], ["p", "x", "y", "z", "q", "x", "y", "z"]
    assert list(hits(in_bytes(a, b), [1, 2], 3)) == [(1, 1, 3), (1, 5, 7)]
    assert list(hits(in_bytes(a, b), [2, 2], 3)) == []
    assert list(hits(in_bytes(a, b), [3, 2], 3)) == [(0, 3, 5)]


def plain_hits(texts, owners, width):
    """Covered words of each text, by comparing all windows."""
    least = {}
    for t, o in zip(texts, owners, strict=True):
        for i in range(len(t) - width + 1):
            least[tuple(t[i:i + width])] = min(o, least.get(tuple(t[i:i + width]), o))
    return {(k, j) for k, (t, o) in enumerate(zip(texts, owners, strict=True)) for i in range(len(t) - width + 1)
            if least[tuple(t[i:i + width])] < o for j in range(i, i + width)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), max_size=25), st.integers(0, 4)), max_size=6), st.integers(1, 4))
def test_passages_of_any_owners(pairs, width):
    texts, owners = [t for t, _ in pairs], [o for _, o in pairs]
    found = hits(in_bytes(*texts), owners, width) if texts else []
    assert {(k, j) for k, a, b in found for j in range(a, b + 1)} == plain_hits(texts, owners, width)


def test_windows_with_one_fingerprint(monkeypatch):
    own = passages.words.windows

    def coarse(*args):
        prints, first = own(*args)
        return prints & passages.np.uint64(1), first

    monkeypatch.setattr(passages.words, "windows", coarse)
    rng = random.Random(2)
    texts = [[rng.choice("abcd") for _ in range(30)] for _ in range(6)]
    found = hits(in_bytes(*texts), list(range(6)), 3)
    assert {(k, j) for k, a, b in found for j in range(a, b + 1)} == plain_hits(texts, list(range(6)), 3)


def test_common_run_is_no_large_group(spark, monkeypatch):
    """A passage, and a run with other words around it, in a third of the rows: no automaton grows with the table."""
    monkeypatch.setattr(passages, "SHARD_WORDS", 500)

    def bounded(texts, owners, width, found=hits):
        assert sum(len(t.split()) for t in texts) < 2 * 500
        return found(texts, owners, width)

    monkeypatch.setattr(passages, "hits", bounded)
    rng = random.Random(6)
    passage, run = prose(rng, 30), prose(rng, 5)
    contexts = [prose(rng, 9) + run + prose(rng, 9) for _ in range(40)]
    rows = [(i * 7 % 601, " ".join(prose(rng, 20) + (passage if i % 3 == 0 else rng.choice(contexts) if i % 3 == 1 else [])
                                   + prose(rng, 20))) for i in range(600)]
    rows += [(None, rows[0][1]), (0, rows[1][1])]
    assert ran(spark, rows) == brute(rows)


def test_more_words_than_characters():
    n = 1_150_000
    text = " ".join(str(i) for i in range(n)).encode()
    covered = [(k, a, b) for k, a, b in hits([text, text], [1, 2], 3)]
    assert {k for k, _, _ in covered} == {1}
    assert sorted((a, b) for _, a, b in covered)[0][0] == 0 and max(b for _, _, b in covered) == n - 1
    reached = -1
    for _, a, b in sorted(covered):
        assert a <= reached + 1
        reached = max(reached, b)


def test_keys_are_whole_numbers(spark):
    with pytest.raises(TypeError):
        deduplicated(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
