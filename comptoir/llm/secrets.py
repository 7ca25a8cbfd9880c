"""Secret scans: fixed patterns, and a randomness test battery with false-discovery control.

A token is a run of characters that encodings use, unless it looks like a word or a number. Its encoding is
inferred from the characters it has. Three tests ask whether its symbols could be drawn evenly
and independently from that alphabet: chi-squared over cells of the alphabet, runs above and below
its middle, and lag-one serial correlation; Fisher's method makes one p-value of them. Random
tokens have even p-values, others small ones, so the distinct tokens of the whole corpus tell, for
each encoding and class of length, which p-values are rarely reached by tokens that are not random.
A class too sparse to tell has a fixed threshold, by the law of random tokens alone.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm import words
from comptoir.llm.shared import widened

# Fixed patterns, by kind in the order of the list.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: The same as runs of any length of which those under 24 are dropped.
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")
#: Literals of which every assignment has one, in lower case.
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}", re.ASCII)
#: Shorter tokens leave the tests without power.
TOKEN_LEAST = 16
#: Symbols of the encodings, narrowest first; base64 holds both of its variants' last two symbols.
ENCODINGS = (("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"),
             ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
             ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
             ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
             ("base52", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
             ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
             ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
             ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"))
#: Upper ends of the classes of length.
LENGTHS = (20, 24, 32, 48, 64, 128)
BINS = 100
#: Share of false discoveries. Each class counts as if it had PRIOR random tokens besides its own; no threshold is under LEAST
#: (p-values of random tokens are even, so at least that share of them is missed).
FALSE_SHARE, PRIOR, LEAST = 0.05, 60, 0.05
#: Rises from a small to a capital letter that a token of letters alone needs: names have one or two, words none.
RISES = 3

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
_DIGIT, _SMALL, _CAPITAL = (np.zeros(256, bool) for _ in range(3))
_DIGIT[48:58] = _SMALL[97:123] = _CAPITAL[65:91] = True


def _chi_tail(x: float, df: float) -> float:
    """Upper tail of chi-squared, by the cube-root normal form."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def encoding(token: str) -> int | None:
    """Place in ENCODINGS of the narrowest alphabet that holds the token; None for what looks like a word or a number.

    A token needs a letter, and a digit or RISES rises from a small to a capital letter.
    """
    body = token.rstrip("=")
    digits = any(c.isdigit() for c in body)
    if not any(c.isalpha() for c in body) or not digits and sum(
            a.islower() and b.isupper() for a, b in itertools.pairwise(body)) < RISES:
        return None
    have = set(body)
    return next((i for i, (_, symbols) in enumerate(ENCODINGS) if have <= set(symbols)), None)


def randomness(token: str, alphabet: str) -> float:
    """Fisher's p-value of the battery: small if the symbols are uneven or depend on each other."""
    x = np.array([alphabet.index(c) for c in token.rstrip("=")], float)
    n, size = len(x), len(alphabet)
    cells = max(2, min(size, n // 5))  # five symbols to a cell at least
    cell = (x * cells // size).astype(int)
    share = np.bincount(np.arange(size) * cells // size, minlength=cells) / size
    expected = n * share
    uneven = _chi_tail(float(((np.bincount(cell, minlength=cells) - expected) ** 2 / expected).sum()), cells - 1)
    high = x >= size / 2
    a = int(high.sum())
    b = n - a
    if a and b:
        runs, mean = 1 + int((high[1:] != high[:-1]).sum()), 1 + 2 * a * b / n
        deviation = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        in_runs = _two_sided((runs - mean) / deviation)
    else:
        in_runs = 2.0 ** (1 - n)
    c = x - x.mean()
    power = float((c * c).sum())
    serial = _two_sided((float((c[1:] * c[:-1]).sum()) / power * n + 1) / math.sqrt(n)) if power else 2.0 ** (1 - n)
    half = -sum(math.log(max(p, 1e-300)) for p in (uneven, in_runs, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS)


def _runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, least: int) -> np.ndarray:
    """Rows that hold a run of at least so many marked bytes."""
    starts, ends, rows = words.spans(data, offsets, inside)
    return np.unique(rows[ends - starts >= least])


def _rows(texts: pa.Array) -> Iterator[tuple[int, bool, bool]]:
    """(row, may hold base matches, may hold tokens) of the rows that may hold either."""
    for first, _, data, offsets in words.chunks(texts):
        raw = words.LOWER[data].tobytes()
        at = [m.start() for word in KEYWORDS for m in re.finditer(word, raw)]
        at += [m.start() for m in re.finditer(b"AKIA", data.tobytes())]
        base = set((np.searchsorted(offsets, np.array(at, np.int64), "right") - 1).tolist())
        base |= set(_runs(data, offsets, _HEX, HEX_LEAST).tolist())
        starts, ends, rows = words.spans(data, offsets, _TOKEN)
        long = ends - starts >= TOKEN_LEAST - 2
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        rises = np.concatenate([[0, 0], np.cumsum(_SMALL[data[:-1]] & _CAPITAL[data[1:]])])
        begin, end = starts[long], ends[long]
        tokens = set(rows[long][(digits[end] > digits[begin]) | (rises[end] - rises[begin + 1] >= RISES)].tolist())
        for row in sorted(base | tokens):
            yield first + row, row in base, row in tokens


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def tokens(text: str) -> Iterator[tuple[int, int, int, float]]:
    """(start, end, class, p-value) of every token of which an encoding can be inferred."""
    for m in TOKEN.finditer(text):
        body = m[0].rstrip("=")
        if len(body) >= TOKEN_LEAST and (kind := encoding(body)) is not None:
            yield (m.start(), m.end(), kind * (len(LENGTHS) + 1) + length_class(len(body)),
                   randomness(body, ENCODINGS[kind][1]))


def random_spans(text: str, limits: dict[int, float], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of random tokens that no base span already covers."""
    return [(start, 3, end) for start, end, group, p in tokens(text) if p >= limits.get(group, LEAST)
            and not any(a <= start and end <= b for a, _, b in base)]


def threshold(histogram: np.ndarray, share: float = FALSE_SHARE) -> float:
    """Least p-value of a discovery in a class whose tokens' p-values have this histogram."""
    rest = 1 - np.arange(BINS) / BINS
    above = histogram[::-1].cumsum()[::-1]
    false = above - 2 * above[BINS // 2] * rest - 2 * np.sqrt(above + 1)
    fit = np.flatnonzero((false <= share * (above + PRIOR * rest)) & (np.arange(BINS) >= LEAST * BINS))
    return float(fit[0] / BINS)


def thresholds(docs: DataFrame, text: str = "text", share: float = FALSE_SHARE) -> dict[int, float]:
    """Least p-value of a discovery, by class of encoding and length.

    Counts every distinct token of all texts once. Of the tokens above a threshold t, random ones are
    (1 - t) times those in the whole class, which are twice those above 1/2; what exceeds that by more than twice its
    own deviation is false. The threshold is the least one from LEAST on that keeps the share of the false among the tokens above it, those of
    the PRIOR included: one rule for classes of every size, a class without tokens among them. It never exceeds 1/2. What is
    collected is a histogram of fixed size.
    """

    def seen(batches):
        for batch in batches:
            texts, own = batch.column(0), {}
            for row, _, has in _rows(texts):
                if has:
                    whole = texts[row].as_py()
                    own.update((whole[a:b], (g, min(int(p * BINS), BINS - 1))) for a, b, g, p in tokens(whole))
            yield pa.RecordBatch.from_pydict({
                "token": pa.array(list(own), pa.string()), "kind": pa.array([x[0] for x in own.values()], pa.int32()),
                "bin": pa.array([x[1] for x in own.values()], pa.int32())})

    distinct = docs.select(F.col(text)).mapInArrow(seen, "token string, kind int, bin int").groupBy(
        F.xxhash64("token").alias("token"), "kind", "bin").agg(F.lit(1))
    counts: dict[int, np.ndarray] = {}
    for kind, place, n in distinct.groupBy("kind", "bin").count().collect():
        counts.setdefault(kind, np.zeros(BINS))[place] = n
    out = {}
    for kind, histogram in counts.items():
        out[kind] = threshold(histogram, share)
    return out


def found_in(whole: str, limits: dict[int, float], base: bool, has: bool) -> list[tuple[int, int, int]]:
    fixed = base_spans(whole) if base else []
    return sorted(fixed + (random_spans(whole, limits, fixed) if has else []))


SPANS = "array<struct<start: long, kind: string, end: long>>"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = FALSE_SHARE) -> DataFrame:
    """`doc_id, spans` of every row: the spans of its secrets by start, then kind, in code points.

    Kinds are `assign`, `access`, `hex` and `random`. A null or empty text has none; rows keep their
    keys, null and repeated ones too. Other columns are not read. Two scans: one for the
    thresholds of all texts, one for the spans; nothing but distinct tokens is shuffled.
    """
    limits = thresholds(docs, text, share)

    def spans(batches):
        for batch in batches:
            texts = batch.column(1)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, base, has in _rows(texts):
                found[row] = [{"start": a, "kind": KINDS[k], "end": b}
                              for a, k, b in found_in(texts[row].as_py(), limits, base, has)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    of_key = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(spans, f"doc_id {of_key}, spans {SPANS}")


def redact(docs: DataFrame, text: str = "text", share: float = FALSE_SHARE, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, with every secret span of the text replaced by `mark`; null stays null."""
    limits = thresholds(docs, text, share)
    place = docs.columns.index(text)

    def cleaned(batches):
        for batch in batches:
            texts = batch.column(place)
            changed, rows = [], []
            for row, base, has in _rows(texts):
                whole, at, parts = texts[row].as_py(), 0, []
                for start, _, end in found_in(whole, limits, base, has):
                    if start >= at:
                        parts += [whole[at:start], mark]
                    at = max(at, end)
                if parts:
                    rows.append(row)
                    changed.append("".join([*parts, whole[at:]]))
            if rows:
                mask = np.zeros(len(texts), bool)
                mask[rows] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(changed, texts.type))
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], texts, *batch.columns[place + 1:]],
                                             schema=batch.schema)

    return widened(docs, cleaned)
