"""Exact n-gram Jaccard join by PartEnum signatures.

A set is compared with sets of its own band of sizes; bands overlap so that every pair that can
be similar enough shares one. The domain of features is cut into partitions, more of them than a similar
pair can have differences, so that at least one partition is the same in both sets: its content is a
signature. A set of s features differs from a partner in need - 1 = floor(s * (1 - t) / t) features at most,
so it enumerates its first `need` partitions that hold enough features to tell: among the first partitions
that the shorter of both enumerations covers, one of them must agree. Sets with too few such
partitions say so in a second and third kind of signature, which they share among themselves.

Sets of one signature are candidates. In small groups all pairs are, in others each set is paired with the
group's best known one only; what is linked then counts as one, and only sets of different components in the
same group are compared further, by a bound from parities of feature counts. Every pair that is kept is
checked with the sets themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm import words
from comptoir.llm.components import components
from comptoir.llm.shared import free_name, stored
from comptoir.operators.joins import lookup

#: Groups up to this size are compared pair by pair.
SMALL_GROUP = 3
#: Signatures that a task groups at once, on average.
GROUP_ROWS = 1_000_000
#: Rows of a part of a large group, on average, and rows that are compared with each other at once.
PART_ROWS, BLOCK = 4096, 1024


def sets_of(data: np.ndarray, offsets: np.ndarray, hasher: words.Hasher, size: int = 5
            ) -> tuple[np.ndarray, np.ndarray]:
    """Features (64 bits) of all rows in order of row and value, each once, and how many each row has."""
    n = len(offsets) - 1
    starts, ends, row = words.spans(data, offsets, ~words.SPACE)
    keys = hasher.spans(data, starts, ends, words.LOWER)
    shingles, first = words.windows(keys, row, size)
    owner = row[first]
    count = np.bincount(row, minlength=n)
    for k in range(1, size):  # the whole of a shorter text
        rows = np.flatnonzero(count == k)
        if len(rows):
            at = np.searchsorted(row, rows)
            whole, begin = words.windows(keys, row, k)
            shingles = np.concatenate([shingles, whole[np.searchsorted(begin, at)] + np.uint64(k)])
            owner = np.concatenate([owner, rows])
    feature = words.mix(shingles)
    order = np.argsort(feature)
    # a chunk has no more rows than 16 bits count, and these are sorted by their digits
    order = order[np.argsort(owner[order].astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")]
    feature, owner = feature[order], owner[order]
    first = np.ones(len(feature), bool)
    first[1:] = (feature[1:] != feature[:-1]) | (owner[1:] != owner[:-1])
    return feature[first], np.bincount(owner[first], minlength=n)


class Scheme:
    """Bands of sizes and their partitions, for a similarity of `percent` / 100."""

    def __init__(self, percent: int = 80) -> None:
        if not 60 <= percent <= 100:
            raise ValueError("similarity between 60 and 100")
        self.percent = percent
        self.top = [1]  # greatest size of each band; its least size follows from the band before
        self.least = [1]

    def upto(self, size: int) -> None:
        while self.top[-1] < size:
            low = -(-self.percent * (self.top[-1] + 1) // 100)
            self.least.append(low)
            # wide enough that no size is in three bands
            self.top.append(max(2 * low, -(-low * 10000 // self.percent ** 2) + 1))

    def bands(self, sizes: np.ndarray) -> list[np.ndarray]:
        """The band of each size, and the next one where that holds the size too (else -1)."""
        self.upto(int(sizes.max(initial=1)) + 1)
        own = np.searchsorted(self.top, sizes)
        least = np.array([*self.least, 1 << 62])
        return [own, np.where(least[own + 1] <= sizes, own + 1, -1)]

    def need(self, sizes: np.ndarray) -> np.ndarray:
        return sizes * (100 - self.percent) // self.percent + 1

    def partitions(self, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many partitions a band has, and the features that one must hold to tell."""
        top = np.array(self.top)[band]
        apart = (100 - self.percent) / self.percent * top
        heavy = np.where(top >= 64, 2, 1)
        return np.where(top >= 64, np.ceil(1.44 * apart) + 1, np.ceil(2 * apart) + 2).astype(np.int64), heavy


def signatures(features: np.ndarray, sizes: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, and the set of each."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out_sig, out_set = [], []

    def emit(kind, band, part, content, who):
        salt = words.mix((band.astype(np.uint64) << np.uint64(34)) | (part.astype(np.uint64) << np.uint64(2)) | np.uint64(kind))
        out_sig.append(words.mix(content + salt))
        out_set.append(who)

    for band in scheme.bands(sizes):
        band = np.where(sizes > 0, band, -1)
        take = np.flatnonzero(band[owner] >= 0)
        if not len(take):
            continue
        who = owner[take]
        count, heavy = scheme.partitions(np.maximum(band, 0))
        need = scheme.need(sizes)
        # where a feature lies differs between bands, so that no feature is last in all of them
        where = words.mix(features[take] + (band[who].astype(np.uint64) << np.uint64(50)))
        part = (where % count[who].astype(np.uint64)).astype(np.int64)
        order = np.argsort(who * (1 << 32) + part, kind="stable")
        who, part, value = who[order], part[order], words.mix(features[take][order])
        begin = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (part[1:] != part[:-1])])
        content = np.add.reduceat(value, begin)
        held = np.diff(np.append(begin, len(who)))
        who, part = who[begin], part[begin]
        first = np.searchsorted(who, np.arange(len(sizes)))

        def rank(mask, first=first, who=who):
            """How many marked partitions the set has up to each, and in all."""
            sums = np.concatenate([[0], np.cumsum(mask)])
            total = sums[np.append(first[1:], len(who))] - sums[first]
            return sums[1:] - sums[first[who]], total

        telling = held >= heavy[who]
        nth, total = rank(telling)
        chosen = telling & (nth <= need[who])
        emit(0, band[who[chosen]], part[chosen], content[chosen], who[chosen])
        short = (total < need) & (band >= 0)
        if short.any():
            nth, total = rank(np.ones(len(who), bool))
            chosen = short[who] & (nth <= need[who])
            emit(1, band[who[chosen]], part[chosen], content[chosen], who[chosen])
            rest = np.flatnonzero(short & (total < need))
            emit(2, band[rest], np.zeros(len(rest)), np.zeros(len(rest), np.uint64), rest)
    if not out_sig:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_set)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def parities(features: np.ndarray, bits: int) -> bytes:
    """One bit for each of `bits` cells: whether an odd number of the features falls into it."""
    cells = np.bincount((words.mix(features) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits(cells & 1).tobytes()


def parity_bits(scheme: Scheme, size: int) -> int:
    """Cells for sets of this size; the same for all sets that may be similar enough, bands apart."""
    scheme.upto(size)
    # few enough features to a cell that parities hardly ever cancel
    return max(256, 4 << (scheme.top[int(np.searchsorted(scheme.top, size))] - 1).bit_length())


def _folded(bits: np.ndarray, to: int) -> np.ndarray:
    """Parities over fewer cells."""
    while bits.shape[1] * 8 > to:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _pairs_apart(sizes, component, part, sketches, percent):
    """Pairs of one group that are in different components and whose parities allow them to be linked.

    Of a group in two parts, only pairs across them.
    """
    two = part.min() != part.max()
    shortest = min(len(s) for s in sketches)
    bits = np.vstack([_folded(np.frombuffer(s, np.uint8)[None, :], shortest * 8) for s in sketches]).view(np.uint64)
    for i in range(0, len(sizes), BLOCK):
        for j in range(i, len(sizes), BLOCK):
            left, right = slice(i, i + BLOCK), slice(j, j + BLOCK)
            both = sizes[left, None] + sizes[None, right]
            apart = np.zeros(both.shape, np.int32)
            for k in range(bits.shape[1]):
                apart += np.bitwise_count(bits[left, k][:, None] ^ bits[right, k][None, :])
            near = apart * (100 + percent) <= both * (100 - percent)
            near &= component[left, None] != component[None, right]
            if two:
                near &= part[left, None] != part[None, right]
            a, b = np.nonzero(near)
            keep = a + i < b + j
            yield a[keep] + i, b[keep] + j


def join(docs: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_shingles, component_id` of every row: see `classes`."""
    placed = classes(docs, percent, size, key, text)
    least = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return lookup(placed, least, "component").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def representatives(docs: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without those that are in a class with a row of a smaller key: see `classes`.

    Null keys are greater than all others; of rows with one key the first stays.
    """
    placed = classes(docs, percent, size, key, text).where("component is not null")
    order = F.struct(F.col("doc_id").isNull().alias("no_key"), "doc_id", "node")
    least = placed.groupBy("component").agg(F.min(order)["node"].alias("stays"))
    own = free_name(docs, "node")
    gone = lookup(placed, least, "component", "inner").where("node <> stays").select(F.col("node").alias(own))
    numbered = docs.withColumn(own, F.monotonically_increasing_id())
    return numbered.join(gone, own, "left_anti").drop(own)


def classes(docs: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`node, doc_id, n_shingles, component` of every row; node numbers the rows.

    Two rows are linked when the Jaccard similarity of their sets of `size`-word shingles (A-Z in lower
    case; a shorter text is one shingle) is percent / 100 or more; `component` is the smallest node that is
    reachable by links, null without links; `component_id` is the smallest key there. Null and empty texts and texts without words have the empty set and link with nothing.
    Repeated keys are rows of their own; null keys count for no minimum. Other columns are not read.
    `docs` is read several times and must give the same rows in the same order, as a stored table does.

    Features are told apart by 64-bit fingerprints within a pair. Signatures, memberships of groups,
    candidate pairs and components stay distributed; sets are shuffled for candidates alone.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "node", F.monotonically_increasing_id())

    def signed(batches):
        scheme, hasher = Scheme(percent), words.Hasher()
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for first, last, data, offsets in words.chunks(batch.column(1)):
                features, sizes = sets_of(data, offsets, hasher, size)
                signature, who = signatures(features, sizes, scheme)
                yield pa.RecordBatch.from_pydict({"signature": pa.array(signature.view(np.int64)),
                                                  "node": pa.array(nodes[first:last][who])})

    def grouped(batches):
        table = pa.Table.from_batches(batches, pa.schema([("signature", pa.int64()), ("node", pa.int64())]))
        signature, node = table.column(0).to_numpy(), table.column(1).to_numpy()
        order = np.lexsort((node, signature))
        signature, node = signature[order], node[order]
        begin = np.flatnonzero(np.r_[True, signature[1:] != signature[:-1]]) if len(signature) else np.empty(0, np.int64)
        held = np.diff(np.append(begin, len(signature)))
        big = np.repeat(held > SMALL_GROUP, held)
        out = [(signature[big], np.repeat(held, held)[big], node[big])]
        for k in range(2, SMALL_GROUP + 1):
            at = begin[held == k]
            out += [(np.zeros(len(at), np.int64), node[at + i], node[at + j]) for i in range(k) for j in range(i + 1, k)]
        signature, a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        yield pa.RecordBatch.from_pydict({"signature": pa.array(signature), "big": pa.array(
            np.arange(len(a)) < len(out[0][0])), "a": pa.array(a), "b": pa.array(b)})

    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(letters / 16 / GROUP_ROWS))
    groups = stored(rows.select("node", "text").mapInArrow(signed, "signature long, node long")
                    .repartition(tasks, "signature")
                    .mapInArrow(grouped, "signature long, big boolean, a long, b long"))
    small = groups.where("not big and a <> b").groupBy("a", "b").agg(F.lit(1)).select("a", "b")
    # of a larger group (a: its size), the centre is the one that larger groups have in common with most others
    large = groups.where("big").select("signature", F.col("b").alias("node"), F.col("a").alias("held"))
    known_by = large.groupBy("node").agg(F.sum("held").alias("met"))
    centres = large.join(known_by, "node").groupBy("signature").agg(
        F.max(F.struct("met", (-F.col("node")).alias("minus")))["minus"].alias("minus"))
    often = large.join(centres, "signature").groupBy("node", (-F.col("minus")).alias("centre")).agg(F.count("*").alias("n"))
    usual = often.where("node <> centre").groupBy("node").agg(
        F.max(F.struct("n", (-F.col("centre")).alias("minus")))["minus"].alias("minus")).select(
        F.least("node", -F.col("minus")).alias("a"), F.greatest("node", -F.col("minus")).alias("b"))
    pairs = stored(small.union(usual).distinct())

    def sets(batches):
        hasher, scheme = words.Hasher(), Scheme(percent)
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column(1)):
                features, sizes = sets_of(data, offsets, hasher, size)
                limits = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_pydict({
                    "node": batch.column(0).slice(first, last - first), "n": pa.array(sizes),
                    "features": pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(features.view(np.int64))),
                    "sketch": pa.array([parities(features[a:b], parity_bits(scheme, max(b - a, 1)))
                                        for a, b in zip(limits[:-1], limits[1:], strict=True)], pa.binary())})

    needed = groups.select(F.explode(F.when(F.col("big"), F.array("b")).otherwise(F.array("a", "b"))).alias("node")).groupBy("node").agg(F.lit(1)).select("node")
    known = stored(rows.select("node", "text").join(needed, "node", "left_semi").mapInArrow(
        sets, "node long, n long, features array<long>, sketch binary"))

    def checked(candidates: DataFrame) -> DataFrame:
        """The candidates that are linked, by their sets."""

        def similar(batches):
            for batch in batches:
                a, b = batch.column(2), batch.column(3)
                keep = [linked(x.values.to_numpy(), y.values.to_numpy(), percent) for x, y in zip(a, b, strict=True)]
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        one = known.select(F.col("node").alias("b"), F.col("features").alias("of_b"), F.col("n").alias("n_b"))
        two = known.select(F.col("node").alias("a"), F.col("features").alias("of_a"), F.col("n").alias("n_a"))
        both = candidates.join(one, "b").join(two, "a").where(
            f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        return both.select("a", "b", "of_a", "of_b").mapInArrow(similar, "a long, b long")

    links = stored(checked(pairs))
    known_parts = stored(components(links))
    members = large.join(known_parts, "node", "left").select(
        "signature", "node", F.coalesce("component", "node").alias("component"))
    # many signatures have the same members; one of them is enough
    mixed = members.groupBy("signature").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("held"),
        F.bit_xor(F.xxhash64("node")).alias("mark"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("mark2")
    ).where("x <> y").groupBy("held", "mark", "mark2").agg(F.min("signature").alias("signature"))
    # large groups in parts, every pair of parts by itself
    parts = F.ceil(F.col("held") / PART_ROWS).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    dealt = members.join(mixed.select("signature", "held"), "signature").select(
        "signature", "node", "component", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    open_groups = dealt.join(known.select("node", "n", "sketch"), "node").withColumn(
        "low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))

    def compared(table: pa.Table) -> pa.Table:
        node, found = table.column("node").to_numpy(), [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for a, b in _pairs_apart(table.column("n").to_numpy(), table.column("component").to_numpy(),
                                 table.column("part").to_numpy(), table.column("sketch").to_pylist(), percent):
            found.append((node[a], node[b]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    more = stored(open_groups.groupBy("signature", "low", "high").applyInArrow(compared, "a long, b long").groupBy("a", "b").agg(F.lit(1)).select("a", "b"))
    found = links if more.isEmpty() else links.union(checked(more))
    whole = components(found)

    def counted(batches):
        hasher = words.Hasher()
        for batch in batches:
            out = [sets_of(data, offsets, hasher, size)[1] for _, _, data, offsets in words.chunks(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(out) if out else [], pa.int64())],
                                             ["node", "doc_id", "n_shingles"])

    kind = docs.schema[key].dataType.simpleString()
    sized = stored(rows.select("node", "doc_id", "text").mapInArrow(
        counted, f"node long, doc_id {kind}, n_shingles long"))
    return sized.join(whole, "node", "left")
