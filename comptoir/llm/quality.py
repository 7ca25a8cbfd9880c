"""Quality by a sparse ensemble of rules over statistics of a text.

Boosted trees propose rules: the conjunction of the conditions on the way to each of their nodes. A
logistic regression with lasso penalty keeps the few rules that matter, and the result is compiled
into one Spark column expression over the columns of statistics.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm import words
from comptoir.llm.shared import widened

#: Labelled documents of each kind that are learned from, the ones with the least hashes.
GOOD_SAMPLE, BAD_SAMPLE = 4000, 4000
TREES, DEPTH, RATE, SPLITS, LEAF = 60, 3, 0.2, 32, 5
#: Strengths of the lasso that are tried, as shares of the least one that leaves no rule.
STRENGTHS = tuple(0.5 * 0.5 ** k for k in range(7))

STATISTICS = ("bytes", "words", "word_bytes", "upper", "digits", "marks", "other", "bars", "distinct", "top_word",
              "repeats", "marked_words", "long_words", "lines", "line_bytes", "equal_lines", "ends")

_UPPER, _DIGIT, _MARK, _HIGH = (np.zeros(256, np.float32) for _ in range(4))
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_HIGH[128:] = 1
#: Marks that seldom end words of prose.
_ODD = np.zeros(256, np.float32)
_ODD[list(b"!#$%&*+/<=>@\\^_`{|}~")] = 1
_END = np.zeros(256, np.float32)
_END[list(b".?!:;")] = 1
_LINE = np.ones(256, bool)
_LINE[[10, 13]] = False


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; all 0 for null and empty texts."""
    out, hasher = np.zeros((len(texts), len(STATISTICS))), words.Hasher()
    for first, last, data, offsets in words.chunks(texts):
        n = last - first
        starts, ends, row = words.spans(data, offsets, ~words.SPACE)
        size = np.diff(offsets).astype(float)

        def per_byte(table, data=data, offsets=offsets):
            sums = np.concatenate([[0.0], np.cumsum(table[data], dtype=np.float64)])
            return sums[offsets[1:]] - sums[offsets[:-1]]

        count = np.bincount(row, minlength=n).astype(float)
        letters = np.maximum(count, 1)
        solid = np.maximum(np.bincount(row, ends - starts, n), 1)
        keys = hasher.spans(data, starts, ends, words.LOWER)
        of, each = np.unique(words.mix(row.astype(np.uint64) + np.uint64(1)) ^ keys, return_counts=True, return_index=True)[1:]
        top = np.zeros(n)
        np.maximum.at(top, row[of], each)
        distinct = np.bincount(row[of], minlength=n)
        again = np.zeros(len(row))
        again[1:] = (keys[1:] == keys[:-1]) & (row[1:] == row[:-1])
        l_starts, l_ends, l_row = words.spans(data, offsets, _LINE)
        lines = np.bincount(l_row, minlength=n).astype(float)
        l_keys = words.mix(l_row.astype(np.uint64) + np.uint64(1)) ^ hasher.spans(data, l_starts, l_ends)
        l_distinct = np.bincount(l_row[np.unique(l_keys, return_index=True)[1]], minlength=n)
        odd = np.bincount(row, _ODD[data[ends - 1]] if len(ends) else None, n)
        values = [size, count, solid / letters, per_byte(_UPPER) / solid, per_byte(_DIGIT) / solid,
                  per_byte(_MARK) / solid, per_byte(_HIGH) / solid, per_byte(np.eye(256, dtype=np.float32)[124]) / letters,
                  distinct / letters, top / letters, np.bincount(row, again, n) / letters, odd / letters,
                  np.bincount(row, ends - starts > 20, n) / letters, lines, size / np.maximum(lines, 1),
                  1 - l_distinct / np.maximum(lines, 1), per_byte(_END) / letters]
        out[first:last] = np.where(count[:, None] > 0, np.column_stack(values), 0)
    return out


class Rule(NamedTuple):
    """Conditions (statistic, least value or -inf, value it stays below or inf), all of which hold, and a weight."""

    conditions: tuple[tuple[int, float, float], ...]
    weight: float


class Ensemble(NamedTuple):
    rules: tuple[Rule, ...]
    offset: float

    def column(self) -> Column:
        """Probability of good quality, over columns named as STATISTICS."""
        total = F.lit(self.offset)
        for rule in self.rules:
            holds = F.lit(True)
            for at, low, high in rule.conditions:
                value = F.col(STATISTICS[at])
                if low > -np.inf:
                    holds = holds & (value >= low)
                if high < np.inf:
                    holds = holds & (value < high)
            total = total + F.when(holds, F.lit(rule.weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _covers(x: np.ndarray, conditions) -> np.ndarray:
    out = np.ones(len(x), bool)
    for at, low, high in conditions:
        out &= (x[:, at] >= low) & (x[:, at] < high)
    return out


def _narrowed(conditions: dict, at: int, low: float, high: float) -> dict:
    a, b = conditions.get(at, (-np.inf, np.inf))
    return {**conditions, at: (max(a, low), min(b, high))}


def paths(x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 0) -> list[tuple[tuple[int, float, float], ...]]:
    """Conditions on the ways to the nodes of boosted trees, each once."""
    rng, total, found = np.random.default_rng(seed), np.zeros(len(x)), {}
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, SPLITS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)])
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, curve = weight * (y - p), weight * p * (1 - p) + 1e-9
        part = rng.random(len(x)) < 0.7
        features = rng.permutation(x.shape[1])[:max(4, 2 * x.shape[1] // 3)]
        nodes = [(np.arange(len(x)), {}, 0)]
        while nodes:
            rows, conditions, depth = nodes.pop()
            best = None
            fit = rows[part[rows]]
            if depth < DEPTH and len(fit) >= 2 * LEAF:
                for j in features:
                    k = len(cuts[j]) + 1
                    g, h, n = (np.bincount(bins[fit, j], v, k).cumsum() for v in (gradient[fit], curve[fit], np.ones(len(fit))))
                    left, right = slice(None, -1), (g[-1] - g[:-1], h[-1] - h[:-1])
                    gain = g[left] ** 2 / (h[left] + 1) + right[0] ** 2 / (right[1] + 1) - g[-1] ** 2 / (h[-1] + 1)
                    gain[(n[left] < LEAF) | (n[-1] - n[left] < LEAF)] = -1
                    if len(gain) and (best is None or gain.max() > best[0]) and gain.max() > 1e-6:
                        best = (gain.max(), j, int(gain.argmax()))
            if best is None:
                total[rows] += RATE * gradient[fit].sum() / (curve[fit].sum() + 1)
                continue
            _, j, at = best
            cut = float(cuts[j][at])
            below = bins[rows, j] <= at
            for side, low, high in ((rows[below], -np.inf, cut), (rows[~below], cut, np.inf)):
                inner = _narrowed(conditions, j, low, high)
                found[tuple(sorted((int(a), *b) for a, b in inner.items()))] = None
                nodes.append((side, inner, depth + 1))
    return list(found)


def lasso(x: np.ndarray, y: np.ndarray, weight: np.ndarray, strength: float, start: np.ndarray | None = None,
          rounds: int = 150) -> np.ndarray:
    """Weights (the last is the free offset) of a logistic regression, by accelerated proximal steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = weight / weight.sum()
    step = 4 / max(np.linalg.eigvalsh((x * weight[:, None]).T @ x)[-1], 1e-9)
    limit = np.full(x.shape[1], strength * step)
    limit[-1] = 0
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    z, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ z, -500, 500)))
        moved = z - step * (x.T @ (weight * (p - y)))
        new = np.sign(moved) * np.maximum(np.abs(moved) - limit, 0)
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, far = new + (t - 1) / faster * (new - w), np.abs(new - w).max()
        w, t = new, faster
        if far < 1e-5:
            break
    return w


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Ensemble:
    """Rules of the trees, thinned by the lasso whose strength does best on a fifth that is set aside."""
    weight = np.ones(len(y))
    conditions = paths(x, y, weight, seed)
    if not conditions:
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble((), float(np.log(share / (1 - share))))
    made = np.column_stack([_covers(x, c) for c in conditions]).astype(float)
    made, first = np.unique(made, axis=1, return_index=True)
    conditions = [conditions[i] for i in first]
    aside = np.random.default_rng(seed).random(len(y)) < 0.2
    aside &= len(y) >= 50
    most = np.abs((made * (weight / weight.sum())[:, None]).T @ (y - y.mean())).max()

    def loss(w, rows):
        p = np.clip(1 / (1 + np.exp(-np.clip(made[rows] @ w[:-1] + w[-1], -500, 500))), 1e-6, 1 - 1e-6)
        return -(y[rows] * np.log(p) + (1 - y[rows]) * np.log(1 - p)).mean()

    best, w = None, None
    for strength in STRENGTHS:
        w = lasso(made[~aside], y[~aside], weight[~aside], strength * most, w)
        value = loss(w, aside if aside.any() else ~aside)
        if best is None or value < best[0] - 1e-4:
            best = (value, strength)
    w = lasso(made, y, weight, best[1] * most, w, 300)
    kept = np.flatnonzero(np.abs(w[:-1]) > 1e-4)
    return Ensemble(tuple(Rule(conditions[i], float(w[i])) for i in kept), float(w[-1]))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with the columns of STATISTICS; columns of these names are replaced."""
    kept = docs.drop(*STATISTICS)
    place = kept.columns.index(text)

    def counted(batches):
        for batch in batches:
            values = statistics(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(values[:, j].copy()) for j in range(len(STATISTICS)))],
                                             [*batch.schema.names, *STATISTICS])

    return widened(kept, counted, ", ".join(f"{name} double" for name in STATISTICS))


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: tuple[int, int] = (GOOD_SAMPLE, BAD_SAMPLE),
        seed: int = 0) -> Ensemble | None:
    """Rules learned from the labelled documents for which `may_learn` holds; None without both kinds.

    The driver gets statistics of at most sum(sample) documents.
    """
    known = labels.where(may_learn & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    order = F.xxhash64("doc_id")
    chosen = known.where("quality = 1").orderBy(order, "doc_id").limit(sample[0]).union(
        known.where("quality = 0").orderBy(order, "doc_id").limit(sample[1]))
    # at most sum(sample) rows, whatever the size of the tables
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    table = with_statistics(rows).select("doc_id", "quality", *STATISTICS).orderBy("doc_id", *STATISTICS).toPandas()
    y = table["quality"].to_numpy(float)
    if len(set(y)) < 2:
        return None
    shares = labels.where(may_learn).agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).first()
    model = fit_rules(table[list(STATISTICS)].to_numpy(float), y, seed)
    # the sample holds both kinds alike, the labels do not
    prior = np.log(shares.good / shares.bad) - np.log(y.sum() / (len(y) - y.sum()))
    return model._replace(offset=float(model.offset + prior))


def score(docs: DataFrame, model: Ensemble | None, text: str = "text", column: str = "score") -> DataFrame:
    """The same rows and columns with `score`, the probability of good quality, and the columns of STATISTICS.

    Null and empty texts have statistics of 0 and are scored by them; without a model every score is 0.5.
    Whole texts are read; nothing is shuffled.
    """
    counted = with_statistics(docs.drop(column), text)
    return counted.withColumn(column, model.column() if model else F.lit(0.5))
