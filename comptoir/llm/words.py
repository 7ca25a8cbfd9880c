"""Words of many texts at once: positions and 64-bit fingerprints, read off Arrow string buffers.

Equal words have equal fingerprints in every task and on every machine. Different words may share one, if hardly ever: where
equality decides a result, bytes are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes and rows that are handled at once; a single longer text is a chunk of its own.
CHUNK_BYTES, CHUNK_ROWS = 1 << 20, 1 << 15
#: Bytes of a lane; spans up to so many bytes are hashed lane by lane.
_LANE, LANES_BYTES = 8, 32
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(_LANE + 1)], np.uint64)
#: White space of the contracts: \x20 and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number, little-endian; bytes past the end are 0."""
    padded = np.zeros(len(data) + 2 * _LANE, np.uint8)
    padded[:len(data)] = data
    return np.ndarray((len(data) + _LANE,), "<u8", padded, strides=(1,))


class Hasher:
    """Fingerprints of byte spans.

    Spans of less than eight bytes have fingerprints of their own that no other span has. Of longer ones those up to LANES_BYTES are
    mixed eight bytes at a time, others by BLAKE2b.
    """

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
              fold: np.ndarray = SAME) -> np.ndarray:
        """One fingerprint for each span."""
        folded = data if fold is SAME else fold[data]
        return self._spans(folded, lanes(folded), starts, ends)

    def _spans(self, data: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - starts
        out = (at[starts] & _MASKS[np.minimum(size, _LANE)]) << np.uint64(4) | np.minimum(size, _LANE).astype(np.uint64) << np.uint64(1)
        long = np.flatnonzero(size >= _LANE)
        if len(long):
            begin, left = starts[long], size[long]
            sums = mix(left.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            for k in range(LANES_BYTES // _LANE):
                still = np.flatnonzero(left > k * _LANE)
                rest = np.minimum(left[still] - k * _LANE, _LANE)
                lane = at[begin[still] + k * _LANE] & _MASKS[rest]
                sums[still] = mix(sums[still] * np.uint64(0xA24BAED4963EE407) + mix(lane + np.uint64(k + 1)))
            for i in np.flatnonzero(left > LANES_BYTES).tolist():
                digest = hashlib.blake2b(data[begin[i]:begin[i] + left[i]], digest_size=8).digest()
                sums[i] = int.from_bytes(digest, "little")
            out[long] = sums << np.uint64(1) | np.uint64(1)
        return mix(out)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index of each different span, and for each span which of these it equals, byte by byte."""
    at = lanes(data)
    _, first, inverse = np.unique(Hasher()._spans(data, at, starts, ends), return_index=True, return_inverse=True)
    # short spans are told apart by their fingerprints alone
    long = np.flatnonzero((ends - starts >= _LANE) & (first[inverse] != np.arange(len(starts))))
    if _equal(data, at, starts[long], ends[long], starts[first[inverse[long]]], ends[first[inverse[long]]]):
        return first, inverse
    raw, known = data.tobytes(), {}
    inverse = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.unique(inverse, return_index=True)[1], inverse


def _equal(data: np.ndarray, at: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> bool:
    """Whether all spans equal their partners."""
    size = a_end - a
    if (size != b_end - b).any():
        return False
    for k in range(LANES_BYTES // _LANE):
        still = np.flatnonzero(size > k * _LANE)
        mask = _MASKS[np.minimum(size[still] - k * _LANE, _LANE)]
        if ((at[a[still] + k * _LANE] ^ at[b[still] + k * _LANE]) & mask).any():
            return False
    return all(np.array_equal(data[a[i]:a_end[i]], data[b[i]:b_end[i]]) for i in np.flatnonzero(size > LANES_BYTES).tolist())


def windows(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of `size` consecutive words of one row, and the index of each first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.flatnonzero(rows[:n] == rows[size - 1:])
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(powers(0xA24BAED4963EE407 | 1, size + 1)[1:]):
        out += words[k:k + n] * factor
    return mix(out[first]), first


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each text begins (one more for the end); null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or not texts.buffers()[2]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows, up to `limit` bytes and CHUNK_ROWS together."""
    data, offsets = buffer(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, first + CHUNK_ROWS)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the longest runs of bytes marked in the table `inside`."""
    n = len(data)
    mark = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, stops = mark.copy(), mark.copy()
    begins[1:] &= ~mark[:-1] | edge[1:n]
    stops[:-1] &= ~mark[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1


def gather(where: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices where[0], where[0]+1, … (count[0] of them), where[1], … in one array."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(where - (ends - count), count)


class _Generation:
    """Spans and their ids."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.where, self.count = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.ids, self.used, self.held = np.empty(1 << 14, np.uint32), 0, 0

    def of(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of known spans are, and how many."""
        at = np.fromiter(map(self.number.__getitem__, spans), np.int64, len(spans))
        return self.where[at], self.count[at]

    def learn(self, spans: list[bytes], flat: np.ndarray, count: np.ndarray) -> None:
        begin, more = len(self.number), int(count.sum())
        for name, need in (("where", begin + len(spans)), ("count", begin + len(spans)), ("ids", self.used + more)):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.concatenate([old, np.empty(max(need - len(old), len(old) // 2), old.dtype)]))
        self.where[begin:begin + len(spans)] = self.used + np.cumsum(count) - count
        self.count[begin:begin + len(spans)] = count
        self.ids[self.used:self.used + more] = flat
        self.number.update(zip(spans, range(begin, begin + len(spans)), strict=True))
        self.used += more
        self.held += sum(map(len, spans)) + 160 * len(spans) + 6 * more


class Memo:
    """Ids of byte spans, each distinct span encoded once; told apart by their bytes.

    Beyond half of `limit` bytes a new generation begins; what is met again moves over from the last one.
    """

    def __init__(self, limit: int = 96 << 20) -> None:
        self.limit, self.young, self.old = limit, _Generation(), _Generation()

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, encode,
                fold: np.ndarray = SAME) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans, one after the other, and how many each has.

        `encode` makes arrays of ids of a list of strings: the spans not met before, folded.
        """
        folded = data if fold is SAME else fold[data]
        first, inverse = distinct(folded, starts, ends)
        raw = folded.tobytes()
        spans = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        if self.young.held > self.limit // 2:
            self.young, self.old = _Generation(), self.young
        young, old = self.young, self.old
        missing = [s for s in spans if s not in young.number]
        met = [s for s in missing if s in old.number]
        if met:
            where, count = old.of(met)
            young.learn(met, old.ids[gather(where, count)], count)
        new = [s for s in missing if s not in young.number]
        if new:
            ids = encode([s.decode() for s in new])
            young.learn(new, np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))
        where, count = young.of(spans)
        where, count = where[inverse], count[inverse]
        return young.ids[gather(where, count)], count
