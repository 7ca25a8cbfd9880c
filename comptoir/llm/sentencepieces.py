"""SentencePiece encoding and decoding on the tokenizers library, rebuilt from the model file.

The protobuf is read field by field; normaliser, space marker, pieces with their scores and byte
fallback are rebuilt. Scores are a unigram model's log-probabilities, or the order of a BPE
model's merges. No piece continues past the begin of a space marker, so a text is
encoded word by word, each distinct word once, in multithreaded batches, and every such word is
checked against the SentencePiece library itself.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from comptoir.llm import words
from comptoir.llm.shared import once

SPACE = "▁"
# Fixed values of the format: model types, and types of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Model(NamedTuple):
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    unknown: int
    charsmap: bytes
    add_prefix: bool
    remove_extra: bool


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at:at + size], at + size
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            raise ValueError(f"wire type {wire}")
        yield number, value


def parse(data: bytes) -> Model:
    """The parts of a serialized model that encoding needs."""
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(data):
        if number == 1:
            own = dict(fields(value))
            pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    return Model(pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), unknown, normalizer.get(2, b""),
                 bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)))


def rebuild(model: Model) -> Tokenizer:
    """Tokenizer of whole texts: normaliser, space marker, pieces and byte fallback."""
    vocabulary = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        merges = []
        for i, (piece, score, kind) in enumerate(model.pieces):
            if kind in (NORMAL, USER_DEFINED):
                merges += [(-score, i, k, piece[:k], piece[k:]) for k in range(1, len(piece))
                           if piece[:k] in vocabulary and piece[k:] in vocabulary]
        core = models.BPE(vocabulary, [x[3:] for x in sorted(merges)], byte_fallback=model.byte_fallback,
                          unk_token=model.pieces[model.unknown][0], fuse_unk=True)
    else:
        raise ValueError(f"model type {model.kind}")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    out.normalizer = normalizers.Sequence(steps)
    if splits_at_spaces(model):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"), "isolated")
    out.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse(),
                                     *([decoders.Strip(" ", 1, 0)] if model.add_prefix else [])])
    return out


def splits_at_spaces(model: Model) -> bool:
    """Whether no piece goes on into a space marker, so that words are encoded apart."""
    return not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece, _, _ in model.pieces)


def piece_bytes(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that the pieces stand for, one after the other, and where each begins (one more for the end)."""
    own = []
    for piece, _, kind in model.pieces:
        if kind == BYTE:
            own.append(bytes([int(piece[3:5], 16)]))
        elif kind == CONTROL:
            own.append(b"")
        elif kind == UNKNOWN:
            own.append(" ⁇ ".encode())
        else:
            own.append(piece.replace(SPACE, " ").encode())
    return np.frombuffer(b"".join(own), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in own])])


class Codec:
    """Encodes and decodes texts of many rows in one task."""

    def __init__(self, data: bytes) -> None:
        self.model = parse(data)
        self.whole = rebuild(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes, self.begins = piece_bytes(self.model)
        self.marked = np.array([p.startswith(SPACE) and t != UNKNOWN for p, _, t in self.model.pieces])
        self.by_word = (splits_at_spaces(self.model) and self.model.add_prefix and not self.model.charsmap
                        and not self.model.remove_extra)
        self.core = Tokenizer(self.whole.model)
        self.core.normalizer = normalizers.Replace(" ", SPACE)
        self.memo, self.checked, self.differing = words.Memo(), 0, 0

    def _parity(self, got: list[list[int]], expected: list[list[int]]) -> list[np.ndarray]:
        """The rebuilt tokenizer's ids; where the library's own differ, that is counted."""
        self.checked += len(got)
        self.differing += sum(a != b for a, b in zip(got, expected, strict=True))
        return [np.array(x, np.uint32) for x in got]

    def _words(self, strings: list[str]) -> list[np.ndarray]:
        got = [x.ids for x in self.core.encode_batch_fast(strings, add_special_tokens=False)]
        # the library puts the marker before a text itself, but not before an empty one
        expected = self.reference.encode([x[1:] for x in strings], num_threads=1)
        return self._parity(got, [e if s != " " else [self.reference.piece_to_id(SPACE)]
                                  for s, e in zip(strings, expected, strict=True)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        n = len(offsets) - 1
        if not self.by_word:
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            got = [x.ids for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            ids = self._parity(got, self.reference.encode(texts, num_threads=1))
            return np.concatenate(ids) if ids else np.empty(0, np.uint32), np.fromiter(map(len, ids), np.int64, n)
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        marked = np.insert(data, offsets[full], 32)  # the prefix of each text
        begin = offsets[full] + np.arange(len(full))
        space = marked == 32
        edge = space.copy()
        edge[1:] &= ~space[:-1]
        edge[3:] &= (marked[:-3] != 0xE2) | (marked[1:-2] != 0x96) | (marked[2:-1] != 0x81)  # the marker itself
        edge[begin] = True
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(marked))
        ids, count = self.memo.look_up(marked, starts, ends, self._words)
        row = full[np.searchsorted(begin, starts, "right") - 1]
        return ids, np.bincount(row, count, n).astype(np.int64)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, one after the other, and where each begins (one more for the end)."""
        size = (self.begins[1:] - self.begins[:-1])[ids]
        out = self.bytes[words.gather(self.begins[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        if self.model.add_prefix:  # the marker that encoding put before each text
            has = count > 0
            first = ends[:-1][has][self.marked[ids[(np.cumsum(count) - count)[has]]]]
            keep = np.ones(len(out), bool)
            keep[first] = False
            out, ends = out[keep], np.concatenate([[0], np.cumsum(keep)])[ends]
        return out, ends


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, ids (little-endian unsigned 32-bit), n_ids, round_trip, n_differing` of every row.

    `round_trip`: the ids decode to the text again, byte by byte. `n_differing`: distinct words first
    met in this row's chunk whose ids are not those that the SentencePiece library gives. A null or empty text has no ids. Keys are kept, null and repeated ones too;
    other columns are not read. The file is sent along with the tasks; nothing is shuffled.
    """
    with open(path, "rb") as file:
        data = file.read()
    model, digest = docs.sparkSession.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()

    def encoded(batches):
        codec = once(("codec", digest), lambda: Codec(model.value))
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column(1)):
                before = codec.differing
                ids, count = codec.encode(data, offsets)
                back, begins = codec.decode(ids, count)
                sizes = np.diff(offsets)
                if len(back) == len(data) and (np.diff(begins) == sizes).all():
                    wrong = np.bincount(np.searchsorted(offsets, np.flatnonzero(back != data), "right") - 1,
                                        minlength=last - first) > 0
                else:
                    raw, again = data.tobytes(), back.tobytes()
                    wrong = np.array([raw[a:b] != again[c:d] for a, b, c, d in zip(
                        offsets[:-1], offsets[1:], begins[:-1], begins[1:], strict=True)])
                limits = np.concatenate([[0], np.cumsum(count)]) * 4
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(first, last - first),
                    "ids": pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [
                        None, pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary()),
                    "n_ids": pa.array(count), "round_trip": pa.array(~wrong),
                    "n_differing": pa.array(np.full(last - first, codec.differing - before))})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(
        encoded, f"doc_id {kind}, ids binary, n_ids long, round_trip boolean, n_differing long")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`doc_id, text` of every row's ids; null ids give null, invalid bytes the replacement character."""
    with open(path, "rb") as file:
        data = file.read()
    model, digest = encoded.sparkSession.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()

    def decoded(batches):
        codec = once(("codec", digest), lambda: Codec(model.value))
        for batch in batches:
            column = pc.fill_null(batch.column(1), b"")
            count = pc.binary_length(column).to_numpy(zero_copy_only=False) // 4
            flat = np.frombuffer(b"".join(column.to_pylist()), "<u4")
            raw, begins = codec.decode(flat, count)
            whole = raw.tobytes()
            texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
            valid = batch.column(1).is_valid().to_pylist()
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(
                [t if ok else None for t, ok in zip(texts, valid, strict=True)], pa.string())})

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key), F.col(ids)).mapInArrow(decoded, f"doc_id {kind}, text string")
