"""Near-duplicate embeddings by product quantisation.

Vectors of length one are put into the inverted list of the nearest of some centroids, with a code for
each part of the residual. A vector probes the lists of its nearest centroids; distances to their members are
sums of table entries, one per code. A member's own quantisation error bounds how far such a
sum may be off, so no pair of a probed list is lost before the exact cosine decides.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.components import components
from comptoir.llm.shared import stored
from comptoir.llm.topk import finite
from comptoir.operators.joins import lookup

#: Vectors that centroids and codes are fitted on, the ones with the least hashes.
SAMPLE = 16384
#: Members of a list, on average; lists there are at most; lists a vector probes.
LIST_ROWS, LISTS, PROBES = 512, 1024, 8
#: Parts of a residual, and codes of a part.
PARTS, CODES = 8, 256
#: Members, and as many queries, that a task compares, on average.
BLOCK = 2048
#: Pairs whose cosines are computed at once.
PAIRS = 1 << 15


class Index(NamedTuple):
    """Centroids of the lists, and codebooks (part, code, component) of residuals; vectors have `size` components."""

    size: int
    centroids: np.ndarray
    cuts: tuple[int, ...]
    codebooks: tuple[np.ndarray, ...]


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1), 0)


def centers_of(x: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Centers of `count` clusters, by rounds of assignment and averaging."""
    centers = x[rng.permutation(len(x))[:count]].copy()
    for _ in range(rounds):
        near = _distances(x, centers).argmin(1)
        held = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centers)
    return centers


def fit_index(sample: np.ndarray, lists: int, seed: int = 0) -> Index:
    """Index fitted on vectors of length one."""
    rng, size = np.random.default_rng(seed), sample.shape[1]
    centroids = centers_of(sample, min(lists, len(sample)), rng)
    residual = sample - centroids[_distances(sample, centroids).argmin(1)]
    cuts = tuple(int(c) for c in np.unique(np.linspace(0, size, min(PARTS, size) + 1).astype(int)))
    books = tuple(centers_of(residual[:, a:b], min(CODES, len(sample)), rng) for a, b in zip(cuts[:-1], cuts[1:], strict=True))
    return Index(size, centroids, cuts, books)


def encoded(x: np.ndarray, index: Index, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists that each vector probes (its own first), codes of its residual there, and what the codes miss."""
    distance = _distances(x, index.centroids)
    near = np.argsort(distance, axis=1, kind="stable")[:, :probes]
    residual = x - index.centroids[near[:, 0]]
    codes, missed = np.empty((len(x), len(index.codebooks)), np.uint8), np.zeros(len(x))
    for part, (a, b, book) in enumerate(zip(index.cuts[:-1], index.cuts[1:], index.codebooks, strict=True)):
        codes[:, part] = _distances(residual[:, a:b], book).argmin(1)
        missed += ((residual[:, a:b] - book[codes[:, part]]) ** 2).sum(1)
    return near, codes, np.sqrt(missed)


def near_pairs(queries: np.ndarray, members: np.ndarray, codes: np.ndarray, missed: np.ndarray, index: Index | None,
               at: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) of vectors of length one whose cosine is `least` or more.

    `at` is the list of the members; without an index every pair is compared.
    """
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    reach = math.sqrt(2 - 2 * least) + 1e-6
    for i in range(0, len(queries), 256):
        some = queries[i:i + 256]
        if index is None:
            a, b = np.nonzero(np.ones((len(some), len(members)), bool))
        else:
            residual, total = some - index.centroids[at], np.zeros((len(some), len(members)))
            for part, (c, d, book) in enumerate(zip(index.cuts[:-1], index.cuts[1:], index.codebooks, strict=True)):
                total += _distances(residual[:, c:d], book)[:, codes[:, part]]
            a, b = np.nonzero(np.sqrt(total) <= reach + missed)
        for j in range(0, len(a), PAIRS):
            x, y = a[j:j + PAIRS], b[j:j + PAIRS]
            keep = np.einsum("ij,ij->i", some[x], members[y]) >= least
            found.append((x[keep] + i, y[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def smallest_reachable(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each node of a small graph the smallest node it is connected with."""
    label = np.arange(nodes)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(vectors: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding",
                    probes: int = PROBES, seed: int = 0) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row.

    Pairs that are found and have a cosine of `least` or more, in double precision, are linked. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, and so do rows with a
    null key (which are kept) and vectors of different lengths. Equal vectors are compared as one and count
    as many; rows with one key are rows of their own. `kept`: the row's key is the smallest that is reachable by links.
    Other columns are not read.

    The index is fitted on SAMPLE vectors of the commonest length; all rows are indexed. Rows of other
    lengths are compared exactly, each length as one list. Lists of any size are compared in blocks; a
    block returns a count for each vector and a spanning forest, not its pairs.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    v = F.transform("v", lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    takes_part = finite(F.col("v")) & F.col("vec_id").isNotNull() & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    numbered = rows.select("vec_id", F.when(takes_part, v).alias("v")).select(
        "vec_id", "v", *(F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(i), "v")).alias(f"hash{i}") for i in (0, 1)))
    hashes = ["hash0", "hash1"]
    one = F.when(F.min("v") == F.max("v"), F.min("v")).otherwise(F.raise_error(F.lit("two vectors with one hash of 128 bits")))
    nodes = stored(numbered.where("v is not null").groupBy(*hashes).agg(
        F.count("*").alias("weight"), one.alias("v")).withColumn("node", F.monotonically_increasing_id()))
    numbered = numbered.drop("v")
    sizes = nodes.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    index = None
    if sizes is not None:
        chosen = nodes.where(F.size("v") == sizes[0]).orderBy(*hashes).limit(SAMPLE).select("v").collect()
        sample = _unit(np.array([r.v for r in chosen], float))
        index = fit_index(sample, max(1, min(LISTS, math.ceil(sizes[1] / LIST_ROWS))), seed)
    shared = spark.sparkContext.broadcast(index)

    def indexed(batches):
        for batch in batches:
            column = batch.column(2)
            length = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            begin = column.offsets.to_numpy() - column.offsets.to_numpy()[0]
            out = []
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                x = _unit(flat[begin[at][:, None] + np.arange(size)])
                if size == shared.value.size:
                    near, codes, missed = encoded(x, shared.value, probes)
                    out.append((at, x, near.tolist(), [c.tobytes() for c in codes], missed))
                else:
                    out.append((at, x, [[-size]] * len(at), [b""] * len(at), np.zeros(len(at))))
            at = pa.array(np.concatenate([o[0] for o in out]) if out else np.empty(0, np.int64))
            yield pa.RecordBatch.from_pydict({
                "node": batch.column(0).take(at), "weight": batch.column(1).take(at),
                "x": pa.array([r.tobytes() for o in out for r in o[1]], pa.binary()),
                "probes": pa.array([p for o in out for p in o[2]], pa.list_(pa.int32())),
                "codes": pa.array([c for o in out for c in o[3]], pa.binary()),
                "missed": pa.array(np.concatenate([o[4] for o in out]) if out else np.empty(0), pa.float64())})

    listed = stored(nodes.select("node", "weight", "v").mapInArrow(indexed, "node long, weight long, x binary, probes array<int>, codes binary, missed double"))
    members = listed.withColumn("list", F.col("probes")[0])
    queries = listed.select("node", "weight", "x", "probes", F.explode("probes").alias("list"))
    parts = members.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("m")).join(
        queries.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("q")), "list")

    def dealt(frame, own, other):
        return frame.join(parts, "list").withColumn(
            f"in_{own}", F.pmod(F.xxhash64("node"), F.col(own)).cast("int")).withColumn(
            f"in_{other}", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("m", "q")

    cell = ["list", "in_m", "in_q"]

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        """Partial counts of links, and links enough to connect what is linked."""
        empty = pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        at = left.column("list")[0].as_py()
        own = shared.value if at >= 0 else None
        x, y = (np.vstack([np.frombuffer(b, float) for b in t.column("x").to_pylist()]) for t in (left, right))
        node_m, node_q = left.column("node").to_numpy(), right.column("node").to_numpy()
        codes = np.vstack([np.frombuffer(c, np.uint8) for c in left.column("codes").to_pylist()])
        a, b = near_pairs(y, x, codes, left.column("missed").to_numpy(), own, at, least)
        apart = node_q[a] != node_m[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return empty
        weight_m, weight_q = left.column("weight").to_numpy(), right.column("weight").to_numpy()
        count_q = np.bincount(a, weight_m[b], len(node_q)).astype(np.int64)
        # a member that does not probe the query's own list never finds it itself
        home = np.array([p[0] for p in right.column("probes").to_pylist()])
        probed = [set(p) for p in left.column("probes").to_pylist()]
        homes = np.unique(home)
        finds = np.array([[h in p for h in homes.tolist()] for p in probed])
        alone = ~finds[b, np.searchsorted(homes, home[a])]
        count_m = np.bincount(b[alone], weight_q[a[alone]], len(node_m)).astype(np.int64)
        both = np.concatenate([node_q, node_m])
        label = smallest_reachable(len(both), a, b + len(node_q))
        n = np.concatenate([count_q, count_m])
        take = np.flatnonzero((n > 0) | (label != np.arange(len(both))))
        return pa.table({"node": both[take], "n": n[take], "other": both[label[take]]})

    asked = dealt(queries, "q", "m")
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))  # columns of its own
    found = stored(dealt(members, "m", "q").groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(
        compared, "node long, n long, other long"))
    parts_of = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("node").agg(F.sum("n").alias("others"))
    known = nodes.select(*hashes, "node", "weight").join(links, "node", "left").join(parts_of, "node", "left").withColumn(
        "group", F.coalesce("component", "node"))
    full = lookup(numbered, known, hashes)  # rows of equal vectors, however many, are split
    smallest = full.where("group is not null").groupBy("group").agg(F.min("vec_id").alias("first"))
    return lookup(full, smallest, "group").select(
        "vec_id", (F.coalesce("others", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("first", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("first", "vec_id"), F.lit(True)).alias("kept"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)

