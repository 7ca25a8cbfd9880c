"""Packing by power-of-two decomposition: no sequence crosses documents, and none is padded."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from comptoir.llm import words
from comptoir.llm.shared import once

END_ID = 2
SEQUENCE = 4096
_LATIN = re.compile(r"[a-zÀ-ÖØ-öø-ÿ]+")

# Classes of bytes: 0 white space, 1 ASCII letter, 2 ASCII digit, 3 other ASCII, 4 apostrophe, 5 beyond ASCII.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[words.SPACE] = 0
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[48:58] = 2
_CLASS[39] = 4
_CLASS[128:] = 5
# Neighbours between which every match of the tokenizer's splitting pattern ends.
_SPLIT = np.zeros((6, 6), bool)
_SPLIT[2, 1:5] = _SPLIT[1:5, 2] = True
_SPLIT[1, 3:5] = _SPLIT[3, 1] = True


class Units:
    """Ids of texts by a tokenizer with word ends, each distinct unit encoded once.

    A unit is cut where the tokenizer's own splitting pattern surely ends a match, so the ids of
    a text are the ids of its units, one after the other.
    """

    def __init__(self, path: str) -> None:
        self.full = Tokenizer.from_file(path)
        self.plain, self.latin = Tokenizer(self.full.model), Tokenizer(self.full.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.latin.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.full.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [token.content for token in self.full.get_added_tokens_decoder().values()]
        self.memo = words.Memo()

    def _joined(self, tokenizer: Tokenizer, units: list[str]) -> list[np.ndarray]:
        """Units of one pre-token each; a token with a word end closes each."""
        out: list[np.ndarray] = []
        lines = [units[i:i + 512] for i in range(0, len(units), 512)]
        encoded = tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)
        for line, one in zip(lines, encoded, strict=True):
            ids = np.array(one.ids, np.uint32)
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            out += [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)] if len(cuts) == len(line) else self._whole(line)
        return out

    def _whole(self, units: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.full.encode_batch_fast(units, add_special_tokens=False)]

    def encode(self, units: list[str]) -> list[np.ndarray]:
        kinds: tuple[list, list, list] = ([], [], [])
        for i, unit in enumerate(units):
            if unit.isascii():
                kinds[0 if unit.isalpha() and unit.islower() else 2].append(i)
            else:  # Latin letters: composed, and lower case has no context
                kinds[1 if _LATIN.fullmatch(unit) else 2].append(i)
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(units)
        for kind, own in zip(kinds, (lambda x: self._joined(self.plain, x),
                                     lambda x: self._joined(self.latin, [u.lower() for u in x]),
                                     self._whole), strict=True):
            for i, ids in zip(kind, own([units[i] for i in kind]) if kind else [], strict=True):
                out[i] = ids
        return out

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        n = len(offsets) - 1
        raw = data.tobytes()
        if any(s.encode() in raw for s in self.special):
            ids = self._whole([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, n)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        kind = _CLASS[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge[1:-1] |= _SPLIT.ravel()[kind[:-1] * np.uint8(6) + kind[1:]]
        inside = kind > 0
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        ids, count = self.memo.look_up(data, starts, ends, self.encode, words.LOWER)
        row = np.searchsorted(offsets, starts, "right") - 1
        return ids, np.bincount(row, count, n).astype(np.int64)


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Whole sequences, then the binary digits of what is left, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, longest: int = SEQUENCE, end_id: int = END_ID,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document as pieces of power-of-two length; each piece is a sequence of its own.

    Returns `doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset, bucket`; a bucket holds the sequences of 2**bucket tokens, and each task lays its sequences out
    bucket by bucket. A null or empty text is the end id alone;
    null and repeated keys are kept, each row is a document of its own. Other columns are not read.
    `longest` is a power of two. Nothing is shuffled: sequence ids are unique, not dense.
    """
    if longest & longest - 1:
        raise ValueError("the longest sequence must be a power of two")

    def pieces(batches):
        units = once(("units", tokenizer), lambda: Units(tokenizer))
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column(1)):
                ids, count = units.texts(data, offsets)
                tokens = np.full(len(ids) + len(count), end_id, "<u4")
                tokens[np.arange(len(ids)) + np.repeat(np.arange(len(count)), count)] = ids
                owner, start, length = [], [], []
                for k, n in enumerate((count + 1).tolist()):
                    at = 0
                    for size in piece_lengths(n, longest):
                        owner.append(k)
                        start.append(at)
                        length.append(size)
                        at += size
                limits = np.concatenate([[0], np.cumsum(length)]).astype(np.int64) * 4
                out = {"doc_id": batch.column(0).slice(first, last - first).take(pa.array(owner)),
                       "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                       "ids": pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [
                           None, pa.py_buffer(limits), pa.py_buffer(tokens)]).cast(pa.binary()),
                       "doc_tokens": pa.array((count + 1)[owner], pa.int64())}
                yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[key].dataType.simpleString()
    made = docs.select(F.col(key), F.col(text)).mapInArrow(
        pieces, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")
    bucket = F.round(F.log2("length")).cast("int").alias("bucket")
    return made.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                       bucket).sortWithinPartitions("bucket")
