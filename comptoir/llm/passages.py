"""Substring deduplication: repeated passages, found by sharded Aho-Corasick automata.

Windows of `width` words are routed by their seed, the least fingerprint of the GRAM-word runs inside
them; equal windows have equal seeds. Consecutive windows of one seed travel as one segment, and only
segments whose seed is in two documents travel at all. Of equal segments the one with the smallest key is
examined, and all others are covered by it. A shard of seeds confirms in arrays which windows a document with a smaller key has, too, merges
those that one document has to passages, compiles an automaton of the passages with pyahocorasick (a word is one
letter), and streams all its segments through it: an occurrence of a passage of a document with a smaller key covers its words.

A common seed, one whose segments alone would fill a shard, is not a seed: each of its windows travels by itself, routed by a
fingerprint of the whole window, and a task that has met the window under a smaller key sends only that it is covered.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm import words

GRAM = 5
#: Words of the segments that one automaton is compiled for, on average; a seed with as many is common.
SHARD_WORDS = 400_000
#: For the size of a shard, which is taken by bytes.
LETTERS_A_WORD = 6
#: Common seeds are found in one of so many rows, by hash; in all rows of small tables.
SAMPLE, SAMPLE_LETTERS = 64, 1 << 25
#: Characters that can stand for a word, but for the one that stands for none.
LETTERS = 0x110000 - 2049
NO_KEY = (1 << 63) - 1


class Segments(NamedTuple):
    """Longest runs of windows with one seed: seed, text, first and last window; and the words of all texts."""

    seed: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first_word: np.ndarray
    keys: np.ndarray
    word_row: np.ndarray


def segments(data: np.ndarray, offsets: np.ndarray, width: int) -> Segments:
    starts, ends, row = words.spans(data, offsets, ~words.SPACE)
    keys = words.Hasher().spans(data, starts, ends)
    begin_of = np.searchsorted(row, np.arange(len(offsets) - 1))
    none = np.empty(0, np.int64)
    gram = min(GRAM, width)
    grams, first = words.windows(keys, row, gram)
    spread = width - gram  # a window is `spread` + 1 grams in a row
    n = len(grams) - spread
    if n <= 0:
        return Segments(np.empty(0, np.uint64), none, none, none, starts, ends, begin_of, keys, row)
    least = grams[:n].copy()
    for k in range(1, spread + 1):
        np.minimum(least, grams[k:k + n], out=least)
    whole = np.flatnonzero(row[first[:n]] == row[first[spread:]])  # within one text
    seed, owner = least[whole], row[first[whole]]
    at = first[whole] - begin_of[owner]
    if not len(seed):
        return Segments(seed, owner, at, at, starts, ends, begin_of, keys, row)
    begin = np.flatnonzero(np.r_[True, (seed[1:] != seed[:-1]) | (owner[1:] != owner[:-1])])
    last = np.append(begin[1:], len(seed)) - 1
    return Segments(seed[begin], owner[begin], at[begin], at[last], starts, ends, begin_of, keys, row)


class Copies:
    """Texts, or windows, that a task has met before under a smaller key; told apart by 128-bit BLAKE2b digests."""

    def __init__(self) -> None:
        self.met: dict[bytes, int] = {}

    def again(self, contents: list[bytes], owners: list[int]) -> np.ndarray:
        """Which contents have been met; empty ones have not."""
        out = np.zeros(len(contents), bool)
        for r in sorted(range(len(owners)), key=owners.__getitem__):
            if contents[r]:
                digest = hashlib.blake2b(contents[r], digest_size=16).digest()
                seen = self.met.get(digest)
                if seen is not None and seen < owners[r]:
                    out[r] = True
                elif seen is None or seen > owners[r]:
                    self.met[digest] = owners[r]
        return out


def _texts(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def among(seed: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which seeds are common; `common` is in order."""
    if not len(common):
        return np.zeros(len(seed), bool)
    return common[np.minimum(np.searchsorted(common, seed), len(common) - 1)] == seed


def common_seeds(rows: DataFrame, width: int, letters: int) -> np.ndarray:
    """Seeds whose segments have SHARD_WORDS words or more, in order, estimated from rows by hash.

    `rows` has `node, owner` and the text. This decides only which way a seed goes, not what is found.
    """
    every = max(1, min(SAMPLE, letters // SAMPLE_LETTERS))

    def counted(batches):
        copies = Copies()
        for batch in batches:
            owners = batch.column(1).to_pylist()
            for first, last, data, offsets in words.chunks(batch.column(2)):
                again = copies.again(_texts(data, offsets), owners[first:last])
                found = segments(data, offsets, width)
                new = ~again[found.row]
                keys, place = np.unique(found.seed[new], return_inverse=True)
                held = np.bincount(place, (found.end - found.begin + width)[new], len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"seed": pa.array(keys.view(np.int64)), "held": pa.array(held)})

    taken = rows.where(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).mapInArrow(counted, "seed long, held long")
    found = taken.groupBy("seed").agg(F.sum("held").alias("held")).where(F.col("held") * every >= SHARD_WORDS)
    return np.sort(np.array([r.seed for r in found.select("seed").collect()], np.int64).view(np.uint64))


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of all texts, one after the other, equal for equal words only; and how many each text has."""
    data, offsets = words.buffer(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    starts, ends, row = words.spans(data, offsets, ~words.SPACE)
    return words.distinct(data, starts, ends)[1], np.bincount(row, minlength=len(texts))


def window_classes(number: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A class for each window of the texts, equal for equal windows only; and the first word of each window."""
    prints, first = words.windows(words.mix(number.astype(np.uint64)), row, width)
    _, of, cls = np.unique(prints, return_index=True, return_inverse=True)
    twice = np.flatnonzero(of[cls] != np.arange(len(first)))
    a, b = first[twice], first[of[cls[twice]]]
    if all((number[a + k] == number[b + k]).all() for k in range(width)):
        return cls, first
    known: dict[bytes, int] = {}  # a fingerprint of two windows
    return np.array([known.setdefault(number[i:i + width].tobytes(), len(known)) for i in first.tolist()], np.int64), first


def hits(texts: list[bytes], owners: list[int], width: int) -> Iterator[tuple[int, int, int]]:
    """(text, first and last word) of passages whose windows a text with a smaller owner has, too."""
    number, count = numbered(texts)
    row = np.repeat(np.arange(len(texts)), count)
    cls, first = window_classes(number, row, width)
    if not len(first):
        return
    owner = np.array(owners, np.int64)[row[first]]
    order = np.argsort(cls, kind="stable")
    begin = np.flatnonzero(np.r_[True, np.diff(cls[order]) != 0])
    least = np.empty(int(cls.max()) + 1, np.int64)
    least[cls[order][begin]] = np.minimum.reduceat(owner[order], begin)
    least = least[cls]
    known = least < owner
    if not known.any():
        return
    # passages: windows in a row that one text with a smaller owner has
    same = np.r_[False, known[1:] & known[:-1] & (least[1:] == least[:-1]) & (first[1:] == first[:-1] + 1)
                 & (row[first[1:]] == row[first[:-1]])]
    begin, end = first[known & ~same], first[known & ~np.r_[same[1:], False]] + width
    value = least[known & ~same]
    longest = max(LETTERS // 4, 2 * width)
    parts = -(-(end - begin - width + 1) // (longest - width + 1))  # each window is in a part
    begin = np.repeat(begin, parts) + words.gather(np.zeros(len(parts), np.int64), parts) * (longest - width + 1)
    yield from _located(number, count, begin, np.minimum(np.repeat(end, parts), begin + longest), np.repeat(value, parts), owners)


def _located(number: np.ndarray, count: np.ndarray, begin: np.ndarray, end: np.ndarray, value: np.ndarray, owners: list[int]) -> Iterator[tuple[int, int, int]]:
    """Occurrences of the passages number[begin:end] in all texts whose owner is greater than the passage's value."""
    starts = np.cumsum(count) - count
    # no more different words at once than there are characters
    lot = np.cumsum(end - begin) // (LETTERS // 2)
    for some in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(lot)) + 1):
        own = np.unique(number[words.gather(begin[some], end[some] - begin[some])])
        letter = np.zeros(int(number.max()) + 1, np.uint32)  # 0: in no passage
        letter[own] = np.arange(1, len(own) + 1)
        letter[letter >= 0xD800] += 2048  # no surrogates
        line = letter[number].astype("<u4").tobytes().decode("utf-32-le")
        automaton = ahocorasick.Automaton()
        for a, b, v in zip(begin[some].tolist(), end[some].tolist(), value[some].tolist(), strict=True):
            passage = line[a:b]
            old = automaton.get(passage, None)
            if old is None or v < old[0]:
                automaton.add_word(passage, (v, b - a))
        automaton.make_automaton()
        for k, (a, n) in enumerate(zip(starts.tolist(), count.tolist(), strict=True)):
            first = last = -1
            for at, (v, size) in automaton.iter(line[a:a + n]):
                if v < owners[k]:
                    if first >= 0 and at - size + 1 <= last + 1:
                        first, last = min(first, at - size + 1), at
                    else:
                        if first >= 0:
                            yield k, first, last
                        first, last = at - size + 1, at
            if first >= 0:
                yield k, first, last


def deduplicated(docs: DataFrame, width: int = 13, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same rows and columns with `n_words, n_removed` and `kept`.

    A word is removed if it lies in a window of `width` words that also begins in a row with a smaller key;
    windows are judged on the input. `kept` are the words that stay, joined by one space; null and empty texts have
    none. Keys are whole numbers; a null key is greater than all others, and 2**63 - 1 counts as null. Rows with one key do not
    remove from each other. Columns
    named like the new ones are replaced. `docs` is read several times and must give the same rows in the
    same order, as a stored table does.

    A text that a task has met before under a smaller key is removed as a whole without being routed, so
    a group of copies sends each segment once per task; so it is with windows of common seeds.
    """
    spark = docs.sparkSession
    if docs.schema[key].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("keys must be whole numbers")
    kept = docs.drop("n_words", "n_removed", "kept")
    names = [f"_{i}" for i in range(len(kept.columns))]
    rows = kept.toDF(*names).withColumn("node", F.monotonically_increasing_id())
    text, key = names[kept.columns.index(text)], names[kept.columns.index(key)]

    def seeded(batches):
        copies, met = Copies(), Copies()
        for batch in batches:
            nodes, owners = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for first, last, data, offsets in words.chunks(batch.column(2)):
                again = copies.again(_texts(data, offsets), owners[first:last])
                found = segments(data, offsets, width)
                copy, often = again[found.row], among(found.seed, common.value)
                take = np.flatnonzero(~copy & ~often)
                seed, row, span = [found.seed[take]], [found.row[take]], [(found.begin[take] << 32) | found.end[take]]
                # a copy is covered from its first to its last word
                gone = np.flatnonzero(again)
                count = np.diff(np.append(found.first_word, len(found.starts)))
                gone = gone[count[gone] >= width]
                seed.append(words.mix(nodes[first + gone].astype(np.uint64)))
                row.append(gone)
                span.append(-count[gone])
                take = np.flatnonzero(~copy & often)
                if len(take):  # windows by themselves
                    n = found.end[take] - found.begin[take] + 1
                    of, at = np.repeat(found.row[take], n), words.gather(found.begin[take], n)
                    begin = found.first_word[of] + at
                    raw, starts, ends = data.tobytes(), found.starts.tolist(), found.ends.tolist()
                    windows = [b" ".join([raw[starts[j]:ends[j]] for j in range(i, i + width)]) for i in begin.tolist()]
                    covered = met.again(windows, [owners[first + r] for r in of.tolist()])
                    prints, place = words.windows(found.keys, found.word_row, width)
                    own = prints[np.searchsorted(place, begin)]
                    seed.append(np.where(covered, words.mix(nodes[first + of].astype(np.uint64)), own))
                    row.append(of)
                    span.append(np.where(covered, -1 - ((at << 32) | (at + width - 1)), (at << 32) | at))
                yield pa.RecordBatch.from_pydict({
                    "seed": pa.array(np.concatenate(seed).view(np.int64)), "node": pa.array(nodes[first + np.concatenate(row)]),
                    "span": pa.array(np.concatenate(span))})

    def confirmed(batches):
        """Segments whose seed is in two rows, and what is covered already."""
        table = pa.Table.from_batches(batches, pa.schema([("seed", pa.int64()), ("node", pa.int64()), ("span", pa.int64())]))
        seed, node, whole = (table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2).to_numpy() < 0)
        order = np.lexsort((whole, seed))
        begin = np.flatnonzero(np.r_[True, (seed[order][1:] != seed[order][:-1]) | (whole[order][1:] != whole[order][:-1])])
        if not len(order):
            return
        low, high = np.minimum.reduceat(node[order], begin), np.maximum.reduceat(node[order], begin)
        shared = np.repeat(low < high, np.diff(np.append(begin, len(order)))) | whole[order]
        yield from table.take(pa.array(np.sort(order[shared]))).to_batches(max_chunksize=1 << 17)

    letters = rows.agg(F.sum(F.length(text))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(letters / 32 / 1_000_000))
    slim = rows.select("node", F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("owner"), text)
    common = spark.sparkContext.broadcast(common_seeds(slim, width, letters))
    spots = slim.mapInArrow(
        seeded, "seed long, node long, span long").repartition(tasks, "seed").mapInArrow(
        confirmed, "seed long, node long, span long")
    by_row = spots.groupBy("node").agg(F.collect_list(F.struct("seed", "span")).alias("spots"))

    def cut(batches):
        """Segments with their words, as they stand in the text."""
        at_text, at_key = names.index(text), names.index(key)
        for batch in batches:
            own = batch.column(len(names) + 1)
            held = np.diff(own.offsets.to_numpy())
            below = own.offsets.to_numpy()
            flat = own.flatten()
            nodes = batch.column(len(names)).to_numpy()
            owners = pc.fill_null(batch.column(at_key).cast(pa.int64()), NO_KEY).to_numpy()
            for top, bottom, data, offsets in words.chunks(batch.column(at_text)):
                some = slice(int(below[top] - below[0]), int(below[bottom] - below[0]))
                row = np.repeat(np.arange(bottom - top), held[top:bottom])
                seed, span = (flat.field(f).to_numpy()[some] for f in ("seed", "span"))
                starts, ends, of = words.spans(data, offsets, ~words.SPACE)
                begin_of = np.searchsorted(of, np.arange(bottom - top))
                covered = span < 0
                place = np.where(covered, -1 - span, span)
                first, last = place >> 32, place & 0xFFFFFFFF
                begin = begin_of[row] + first
                sent = np.flatnonzero(~covered)
                raw, listed = data.tobytes(), np.full(len(span), None, object)
                listed[sent] = [raw[a:b] for a, b in zip(starts[begin[sent]].tolist(), ends[
                    (begin + last - first)[sent] + width - 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(seed), pa.array(owners[top + row]), pa.array(nodes[top + row]), pa.array(first.astype(np.int32)),
                    pa.array(np.where(covered, last, -1).astype(np.int32)), pa.array(listed, pa.binary())],
                    ["seed", "owner", "node", "first", "last", "words"])

    def located(batches):
        table = pa.Table.from_batches(batches, pa.schema([
            ("seed", pa.int64()), ("owner", pa.int64()), ("node", pa.int64()), ("first", pa.int32()),
            ("last", pa.int32()), ("words", pa.binary())]))
        table = table.set_column(5, "words", table.column(5).cast(pa.large_binary()))

        def covers(node, first, last):
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                                              ["node", "first", "last"])

        whole = pc.greater_equal(table.column(4), 0)
        done, table = table.filter(whole), table.filter(pc.invert(whole)).sort_by("seed")
        yield covers(*(done.column(i).to_numpy() for i in (2, 3, 4)))
        if not table.num_rows:
            return
        owner, node, first = (table.column(i).to_numpy() for i in (1, 2, 3))
        once = table.column(5).combine_chunks().dictionary_encode()
        code, contents = once.indices.to_numpy(), once.dictionary
        least = np.full(len(contents), NO_KEY)
        np.minimum.at(least, code, owner)
        # equal segments: those with greater keys are covered by the first
        later = np.flatnonzero(owner > least[code])
        size = np.zeros(len(contents), np.int64)
        lead = np.flatnonzero(owner == least[code])
        by_code = lead[np.argsort(code[lead], kind="stable")]
        bounds = np.searchsorted(code[by_code], np.arange(len(contents) + 1))
        letters_of = pc.binary_length(contents).to_numpy()
        # contents are in order of their seeds; those of one seed stay together
        seeds = table.column(0).to_numpy()[np.unique(code, return_index=True)[1]]
        ends = np.append(np.flatnonzero(seeds[1:] != seeds[:-1]) + 1, len(contents))
        held = np.cumsum(letters_of)[ends - 1]
        at = 0
        while at < len(contents):
            reach = (held[np.searchsorted(ends, at) - 1] if at else 0) + SHARD_WORDS * LETTERS_A_WORD
            stop = int(ends[min(max(np.searchsorted(held, reach), np.searchsorted(ends, at, "right")), len(ends) - 1)])
            texts = contents.slice(at, stop - at).to_pylist()
            size[at:stop] = [len(t.split()) for t in texts]
            found = np.array(list(hits(texts, least[at:stop].tolist(), width)), np.int64).reshape(-1, 3)
            k = found[:, 0] + at
            times = bounds[k + 1] - bounds[k]
            to = by_code[words.gather(bounds[k], times)]
            yield covers(node[to], first[to] + np.repeat(found[:, 1], times), first[to] + np.repeat(found[:, 2], times))
            at = stop
        yield covers(node[later], first[later], first[later] + size[code[later]] - 1)

    # both joins take all columns of the rows, so that these are shuffled once
    all_columns = [*names, "node"]
    routed = rows.join(by_row, "node").select(*all_columns, "spots").mapInArrow(
        cut, "seed long, owner long, node long, first int, last int, words binary")
    found = routed.repartition(tasks, "seed").mapInArrow(located, "node long, first int, last int")
    covered = found.groupBy("node").agg(F.collect_list(F.struct("first", "last")).alias("covered"))

    def removed(batches):
        for batch in batches:
            count, gone, left = [], [], []
            column, covers = batch.column(names.index(text)), batch.column(len(names) + 1)
            for r in range(batch.num_rows):
                listed = (column[r].as_py() or "").encode().split()
                count.append(len(listed))
                if covers[r].is_valid:
                    mask = np.zeros(len(listed), bool)
                    own = covers[r].values
                    for a, b in zip(own.field(0).to_pylist(), own.field(1).to_pylist(), strict=True):
                        mask[a:b + 1] = True
                    gone.append(int(mask.sum()))
                    listed = [listed[i] for i in np.flatnonzero(~mask)]
                else:
                    gone.append(0)
                left.append(b" ".join(listed).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(count, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(left, pa.string())], [*names, "n_words", "n_removed", "kept"])

    whole = rows.join(covered, "node", "left").select(*all_columns, "covered")
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept.schema.fields, strict=True))
    return whole.mapInArrow(removed, f"{schema}, n_words long, n_removed long, kept string").toDF(
        *kept.columns, "n_words", "n_removed", "kept")
