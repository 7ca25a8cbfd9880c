"""Toxicity by a support vector machine over gapped character subsequences.

The kernel of two strings sums, over all subsequences of three letters that span at most SPAN
bytes, the products of their weights; a subsequence weighs DECAY to the power of its span. Gaps and
inserted characters therefore lower a similarity and do not end it. The machine is fitted on
Nyström features: similarities to landmarks, whitened by those among the landmarks. Its decision is
linear in the subsequences, so it is folded into one table that scores any text in one pass.

Labels are given to whole documents. A document is toxic if one of its sentences is, and a sentence if
one of its units (words, or single letters in a row, with spaces and marks between) is, so the machine learns from the unit that
best explains each toxic document, and from units of clean ones.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm import words
from comptoir.llm.shared import stored, widened

SPAN, DECAY = 6, 0.7
#: Labelled documents of each kind that are learned from, the ones with the least hashes.
TOXIC_SAMPLE, CLEAN_SAMPLE = 2000, 4000
#: Units of clean documents that are learned from: by hash, by frequency, and the most alike to toxic ones.
BY_HASH, BY_COUNT, HARD = 6000, 3000, 3000
LANDMARKS = 320
#: A unit counts for each toxic document that it explains, and then n / (n + DOUBT) of that, for n of them that hold it.
DOUBT = 4
#: A toxic unit must be decided above all but so many of the clean ones; those that are not are left out, in so many rounds.
BEYOND, ROUNDS = 5, 4
#: Longer units are learned from in pieces that overlap by half.
PIECE = 64

# Symbols: a-z 1 to 26, bytes beyond ASCII 27 to 58 (both cases of a Latin letter alike), others 0: a gap.
SYMBOL = np.zeros(256, np.int32)
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:] = 27 + (np.arange(128, 256) & 31)
CODES = 1 << 18
#: First bytes of letters, as opposed to gaps and to the bytes that continue a letter.
LETTER = SYMBOL > 0
LETTER[128:192] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
#: Bytes of a word of one letter and marks, and of white space between two of them, at most.
SINGLE_BYTES, SPACES = 8, 4
#: (second, third) places of a subsequence, from its first.
PLACES = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


class Model(NamedTuple):
    """Table of weights by subsequence, offset of the decision, and scale and offset of the probability."""

    table: np.ndarray
    bias: float
    scale: float
    shift: float

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * decision + self.shift, -500, 500)))


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of units, and the unit of each byte (-1 between units)."""
    starts, ends, rows = words.spans(data, offsets, ~words.SPACE)
    if not len(starts):
        return starts, ends, rows, np.full(len(data), -1)
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    single = ((letters[ends] - letters[starts] <= 1) & (digits[ends] == digits[starts])
              & (ends - starts <= SINGLE_BYTES))
    joined = np.zeros(len(starts), bool)  # to the word before
    joined[1:] = single[1:] & single[:-1] & (starts[1:] <= ends[:-1] + SPACES) & (rows[1:] == rows[:-1])
    first = np.flatnonzero(~joined)
    last = np.append(first[1:], len(starts)) - 1
    begin, end = starts[first], ends[last]
    step = np.zeros(len(data) + 1, np.int32)
    step[begin] = np.arange(1, len(begin) + 1)
    unit = np.maximum.accumulate(step[:-1])
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end, -1)
    unit = np.where(np.cumsum(inside[:-1], dtype=np.int8) > 0, unit - 1, -1)
    return begin, end, rows[first], unit


def unfilled(data: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Bytes that are kept: of a run of gaps inside a unit only the first, so that SPAN bytes hold three letters."""
    gap = (SYMBOL[data] == 0) & (unit >= 0)
    keep = np.ones(len(data), bool)
    keep[1:] = ~(gap[1:] & gap[:-1] & (unit[1:] == unit[:-1]))
    return keep


def decisions(data: np.ndarray, unit: np.ndarray, count: int, model: Model) -> np.ndarray:
    """Decision of each unit."""
    symbols = SYMBOL[data]
    live = (symbols > 0) & (unit >= 0)
    total, norm = np.zeros(len(data), np.float32), np.zeros(len(data), np.float32)
    n = len(data)
    for a, b in PLACES:
        if n <= b:
            break
        m = n - b
        ok = live[:m] & live[a:a + m] & live[b:] & (unit[:m] == unit[b:])
        code = (symbols[:m] << 12) | (symbols[a:a + m] << 6) | symbols[b:]
        weight = np.float32(DECAY ** (b + 1))
        total[:m] += model.table[code] * (ok * weight)
        norm[:m] += ok * (weight * weight)
    of = unit >= 0
    sums = np.bincount(unit[of], total[of], count)
    norms = np.bincount(unit[of], norm[of], count)
    return sums / np.sqrt(np.maximum(norms, 1e-9)) + model.bias


def occurrences(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, subsequence, weight divided by the string's norm) of a few strings."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    own = np.repeat(np.arange(len(strings)), lengths)
    symbols, out = SYMBOL[data], []
    for a, b in PLACES:
        m = max(len(data) - b, 0)
        ok = np.flatnonzero((symbols[:m] > 0) & (symbols[a:a + m] > 0) & (symbols[b:] > 0) & (own[:m] == own[b:]))
        out.append((own[ok], (symbols[ok] << 12) | (symbols[ok + a] << 6) | symbols[ok + b],
                    np.full(len(ok), DECAY ** (b + 1))))
    who, code, weight = (np.concatenate(x) for x in zip(*out, strict=True))
    norm = np.sqrt(np.maximum(np.bincount(who, weight * weight, len(strings)), 1e-9))
    return who, code, weight / norm[who]


def similarities(strings: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """Kernel of each string with each landmark."""
    who, code, weight = occurrences(landmarks)
    codes, place = np.unique(code, return_inverse=True)
    base = np.zeros((len(codes) + 1, len(landmarks)))
    np.add.at(base, (place, who), weight)
    out = np.zeros((len(strings), len(landmarks)))
    for at in range(0, len(strings), 500):
        who, code, weight = occurrences(strings[at:at + 500])
        place = np.searchsorted(codes, code)
        known = (place < len(codes)) & (codes[np.minimum(place, len(codes) - 1)] == code)
        who, place, weight = who[known], place[known], weight[known]
        order = np.argsort(who, kind="stable")
        own, begins = np.unique(who[order], return_index=True)
        if len(own):
            out[at + own] = np.add.reduceat(base[place[order]] * weight[order, None], begins, axis=0)
    return out


def spread_out(strings: list[bytes], count: int) -> list[bytes]:
    """Up to `count` strings, each the least alike to those before it."""
    if len(strings) <= count:
        return list(strings)
    who, code, weight = occurrences(strings)
    codes, place = np.unique(code, return_inverse=True)
    picked, nearest = [0], np.zeros(len(strings))
    while len(picked) < count:
        mine = who == picked[-1]
        row = np.zeros(len(codes))
        np.add.at(row, place[mine], weight[mine])
        nearest = np.maximum(nearest, np.bincount(who, row[place] * weight, len(strings)))
        nearest[picked[-1]] = np.inf
        picked.append(int(nearest.argmin()))
    return [strings[i] for i in picked]


def disturbed(strings: list[bytes], seed: int) -> list[bytes]:
    """Each string with gaps, with an inserted letter, and with a doubled one."""
    rng, out = np.random.default_rng(seed), []
    for s in strings:
        if len(s) >= 4:
            at = int(rng.integers(1, len(s)))
            letter = bytes([int(rng.integers(97, 123))])
            out += [b"-".join(s[i:i + 1] for i in range(len(s))), s[:at] + letter + s[at:],
                    s[:at] + b"*" + s[at:], s[:at] + s[at - 1:at] + s[at:]]
    return out


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (the last is the offset) of a squared-hinge support vector machine, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge * weight.sum())
    penalty[-1] *= 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        inside = y * (x @ w) < 1
        xs = x[inside] * weight[inside, None]
        new = np.linalg.solve(xs.T @ x[inside] + np.diag(penalty), xs.T @ y[inside])
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w


def fit_units(toxic: list[bytes], clean: list[bytes], seed: int = 0, trust: list[float] | None = None) -> Model:
    """Machine over units; probabilities are not set yet. `trust`: how much each toxic unit counts."""
    positive, negative = toxic + disturbed(toxic, seed), clean + disturbed(clean[:len(clean) // 8], seed + 1)
    sure = np.ones(len(toxic)) if trust is None else np.array(trust)
    sure = np.r_[sure, np.repeat(sure, [4 if len(s) >= 4 else 0 for s in toxic])]
    landmarks = spread_out(positive, LANDMARKS // 2)
    landmarks += spread_out(negative[:3000], LANDMARKS - len(landmarks))
    values, vectors = np.linalg.eigh(similarities(landmarks, landmarks))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    x = np.vstack([similarities(positive, landmarks), similarities(negative, landmarks)]) @ whiten
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    each = np.r_[0.5 * sure / sure.sum(), np.full(len(negative), 0.5 / max(len(negative), 1))] * len(y)
    w = machine(x, y, each)
    who, code, weight = occurrences(landmarks)
    beta = whiten @ w[:-1]
    return Model(np.bincount(code, weight * beta[who], CODES).astype(np.float32), float(w[-1]), 1.0, 0.0)


def probabilities(decision: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the decisions, with softened labels."""
    high, low = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (high + 1) / (high + 2), 1 / (low + 2))
    x, w = np.c_[decision, np.ones(len(decision))], np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        w = w - step * min(1, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def document_decisions(texts: pa.Array, model: Model) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Decision of each text (of its most toxic unit), and bytes where that unit begins and ends."""
    out, at = np.full(len(texts), min(model.bias, -1.0)), [(0, 0)] * len(texts)
    for first, last, data, offsets in words.chunks(texts):
        begin, end, rows, unit = units(data, offsets)
        if not len(begin):
            continue
        keep = unfilled(data, unit)
        values = decisions(data[keep], unit[keep], len(begin), model)
        order = np.lexsort((-np.arange(len(rows)), values, rows))
        best = order[np.append(rows[order][1:] != rows[order][:-1], True)]
        out[first + rows[best]] = values[best]
        for row, a, b in zip(rows[best].tolist(), begin[best].tolist(), end[best].tolist(), strict=True):
            at[first + row] = (a - int(offsets[row]), b - int(offsets[row]))
    return out, at


def _units_of(batches):
    """(document, toxic, unit) once for each unit of a document, in lower case; of 3 bytes at least, long ones in pieces."""
    for batch in batches:
        texts, toxic = batch.column(1), batch.column(2).to_pylist()
        keys = batch.column(0).to_pylist()
        for first, last, data, offsets in words.chunks(texts):
            begin, end, rows, unit = units(data, offsets)
            keep = unfilled(data, unit)
            before = np.concatenate([[0], np.cumsum(keep)])
            begin, end, lowered = before[begin], before[end], words.LOWER[data[keep]].tobytes()
            seen = {(r, lowered[i:min(i + PIECE, b)]) for r, a, b in zip(rows.tolist(), begin.tolist(), end.tolist(), strict=True)
                    if b - a >= 3 for i in range(a, max(b - PIECE // 2, a + 1), PIECE // 2)}
            own = sorted(seen)
            yield pa.RecordBatch.from_pydict({
                "doc": pa.array([keys[first + r] for r, _ in own], pa.int64()),
                "toxic": pa.array([toxic[first + r] for r, _ in own], pa.int32()),
                "unit": pa.array([u for _, u in own], pa.binary())})


def training_rows(docs: DataFrame, labels: DataFrame, may_learn: Column, toxic: int = TOXIC_SAMPLE,
                  clean: int = CLEAN_SAMPLE) -> DataFrame:
    """`doc_id, text, toxic` of a bounded sample of labelled documents, equal texts once."""
    known = labels.where(may_learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    sample = known.where("toxic = 1").orderBy(order, "doc_id").limit(toxic).union(
        known.where("toxic = 0").orderBy(order, "doc_id").limit(clean))
    # at most `toxic` + `clean` rows, whatever the size of the tables
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    return (rows.where("text is not null").withColumn("same", F.xxhash64("text"))
            .dropDuplicates(["same", "toxic"]).select("doc_id", "text", "toxic"))


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: tuple[int, int] = (TOXIC_SAMPLE, CLEAN_SAMPLE),
        seed: int = 0) -> Model | None:
    """Machine learned from the labelled documents for which `may_learn` holds.

    What comes to the driver is bounded by the sizes of the samples. None without documents of both kinds.
    """
    rows = stored(training_rows(docs, labels, may_learn, *sample))
    sizes = dict(rows.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    pairs = stored(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(
        _units_of, "doc long, toxic int, unit binary"))
    counts = stored(pairs.groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))).withColumn(
        "gain", F.col("t") * F.log((F.col("t") + 0.5) * (n_clean + 1) / ((F.col("c") + 0.5) * (n_toxic + 1))))
    strong = counts.where((F.col("t") > 0) & (F.col("gain") > 0))
    best = pairs.where("toxic = 1").join(strong, "unit").groupBy("doc").agg(
        F.max(F.struct("gain", "unit", "t")).alias("best"))
    found = best.groupBy("best.unit", "best.t").count().orderBy(F.desc("count"), "unit").collect()  # one a toxic document at most
    toxic, trust = [bytes(r.unit) for r in found], [r["count"] * r.t / (r.t + DOUBT) for r in found]
    if not toxic:
        return None
    usual = counts.where((F.col("c") > 0) & (F.col("t") * n_clean <= 4 * F.col("c") * n_toxic)).select(
        "unit", "c", F.xxhash64("unit").alias("h"))
    first = [bytes(r.unit) for r in usual.orderBy("h", "unit").limit(BY_HASH).collect()]
    first += [bytes(r.unit) for r in usual.orderBy(F.desc("c"), "unit").limit(BY_COUNT).collect()]
    first = list(dict.fromkeys(first)) or [b"the"]
    rough = fit_units(toxic, first, seed, trust)

    def alike(batches):
        for batch in batches:
            decision, _ = document_decisions(batch.column(0).cast(pa.string(), safe=False), rough)
            yield pa.RecordBatch.from_pydict({"unit": batch.column(0), "value": pa.array(decision)})

    hard = usual.select("unit").mapInArrow(alike, "unit binary, value double").orderBy(
        F.desc("value"), "unit").limit(HARD).collect()
    clean = list(dict.fromkeys([bytes(r.unit) for r in hard] + first))
    model = fit_units(toxic, clean, seed, trust)
    for _ in range(ROUNDS):  # what clean texts say as well explains nothing
        values, usual_values = (document_decisions(pa.array([u.decode("utf-8", "replace") for u in x]), model)[0] for x in (toxic, clean))
        apart = values > np.sort(usual_values)[-min(BEYOND, len(usual_values))]
        if apart.all() or not apart.any():
            break
        toxic, trust = ([x for x, keep in zip(own, apart, strict=True) if keep] for own in (toxic, trust))
        model = fit_units(toxic, clean, seed, trust)

    def scored(batches):
        for batch in batches:
            decision, _ = document_decisions(batch.column(0), model)
            yield pa.RecordBatch.from_pydict({"value": pa.array(decision), "toxic": batch.column(1)})

    known = rows.select("text", "toxic").mapInArrow(scored, "value double, toxic int").collect()
    scale, shift = probabilities(np.array([r.value for r in known]), np.array([r.toxic for r in known]))
    return model._replace(scale=scale, shift=shift)


def score(docs: DataFrame, model: Model | None, text: str = "text", column: str = "score",
          where: str | None = None) -> DataFrame:
    """The same rows and columns with `score`, the probability that the text is toxic.

    Null and empty texts have the score of a text without units; without a model every score is 0.
    `where` names a column for the most toxic unit's span, in bytes. Columns of these names are
    replaced. Whole texts are read; nothing is shuffled.
    """
    kept = docs.drop(column, *([where] if where else []))
    if model is None:
        out = kept.withColumn(column, F.lit(0.0))
        return out.withColumn(where, F.expr("cast(null as struct<start: int, end: int>)")) if where else out
    place, shared = kept.columns.index(text), docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            decision, at = document_decisions(batch.column(place), shared.value)
            columns = [*batch.columns, pa.array(shared.value.probability(decision))]
            if where:
                kind = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                columns.append(pa.array([{"start": a, "end": b} for a, b in at], kind))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, column, *([where] if where else [])])

    return widened(kept, scored, f"{column} double" + (f", {where} struct<start: int, end: int>" if where else ""))
