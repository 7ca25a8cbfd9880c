"""Hard negatives by coordinate pruning over buckets of vectors of like length.

Vectors are dealt into blocks by length, longest first, and a block into buckets. A bucket holds, for each coordinate, a
sorted list of its vectors' values after scaling to length one. An inner product of at least `floor` with an anchor leaves
each coordinate a range of feasible values; the ranges of the anchor's largest coordinates are cut out of the lists
and intersected, and what is left is verified by exact integer products. A bucket, and all shorter ones, is skipped when
even its longest vector is too short. Floors rise while an anchor's best rows fill.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm.shared import stored
from comptoir.operators.joins import lookup

#: Vectors of a block, and anchors that are compared with it at once, on average; vectors of a bucket.
BLOCK, ASKED, BUCKET = 16384, 2048, 1024
#: Classes of length at most; coordinates of an anchor whose ranges are intersected.
CLASSES, FOCUS = 64, 6
#: Room for rounding in the bounds; the verification is exact.
SLACK = 1e-9
NO_FLOOR = -(1 << 63)
NO_CEILING = (1 << 63) - 1


class Bucket:
    """Vectors of like length and the sorted list of each coordinate."""

    def __init__(self, vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        self.vectors, self.ids, self.labels, self.longest = vectors, ids, labels, float(norms.max())
        unit = vectors / np.where(norms > 0, norms, 1)[:, None]
        order = np.argsort(unit, axis=0, kind="stable")
        self.lists = np.ascontiguousarray(np.take_along_axis(unit, order, 0).T)
        self.order = np.ascontiguousarray(order.T.astype(np.int32))
        self.place = np.empty_like(self.order)  # of a vector in a list
        np.put_along_axis(self.place, self.order, np.arange(len(ids), dtype=np.int32)[None, :], 1)

    def feasible(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors that lie in the feasible range of every focus coordinate."""
        if cosine <= 0 or not len(focus):
            return np.arange(len(self.ids))
        cosine = min(1.0, cosine)
        q = unit[focus]
        spread = np.sqrt(np.maximum((1 - cosine * cosine) * (1 - q * q), 0))
        low = np.where(-q >= cosine, -1.0, q * cosine - spread) - SLACK
        high = np.where(q >= cosine, 1.0, q * cosine + spread) + SLACK
        cuts = [(int(self.lists[f].searchsorted(a)), int(self.lists[f].searchsorted(b, "right")), int(f))
                for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist(), strict=True)]
        cuts.sort(key=lambda c: c[1] - c[0])
        begin, end, f = cuts[0]
        left = self.order[f, begin:end]
        for begin, end, f in cuts[1:]:
            place = self.place[f, left]
            left = left[(place >= begin) & (place < end)]
        return left


def _rows(weights: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components of all vectors, and where each begins and how many it has."""
    array = weights.combine_chunks()
    offsets = array.offsets.to_numpy()
    return array.flatten().to_numpy(zero_copy_only=False), offsets[:-1] - offsets[0], np.diff(offsets)


def index(candidates: pa.Table) -> list[list[Bucket]]:
    """Buckets in order of falling length, for each number of components."""
    flat, begin, size = _rows(candidates.column("weights"))
    ids, labels = candidates.column("id").to_numpy(), candidates.column("label").to_numpy()
    out = []
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        vectors = flat[begin[at][:, None] + np.arange(n)]
        norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
        order = np.argsort(-norms, kind="stable")
        if n * float(np.abs(vectors).max(initial=0)) ** 2 < 1 << 50:
            vectors = vectors.astype(float)  # products of whole numbers are exact, and faster
        out.append([Bucket(vectors[o], norms[o], ids[at][o], labels[at][o])
                    for o in (order[i:i + BUCKET] for i in range(0, len(order), BUCKET))])
    return out


def search(buckets: list[list[Bucket]], anchor: np.ndarray, own: int, label: int, other: bool,
           bands: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Scores and ids of the k best rows whose score is in each band (both ends included).

    With `other` rows of another label than `label` count, else rows of that label; never those with the id `own`.
    """
    best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(bands)
    floors = [low for low, _ in bands]
    for row in buckets:
        n = row[0].vectors.shape[1]
        q = np.zeros(n, np.int64)
        q[:len(anchor)] = anchor[:n]
        length = math.sqrt(float((q.astype(float) ** 2).sum()))
        unit = q / length if length else q.astype(float)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        limit = (1 << 53) / max(1, n * int(np.abs(q).max(initial=0)))
        for bucket in row:
            floor, reach = min(floors), length * bucket.longest
            if floor > reach * (1 + SLACK):
                break
            at = bucket.feasible(unit, focus, floor / reach * (1 - SLACK) if floor > 0 else 0.0)
            mine = bucket.labels[at] == label
            at = at[(~mine if other else mine) & (bucket.ids[at] != own)]
            taken = bucket.vectors[at]
            if taken.dtype == float and bucket.longest >= limit:
                taken = taken.astype(np.int64)
            scores = (taken @ q.astype(taken.dtype)).astype(np.int64)
            hit = np.flatnonzero(scores >= floor)
            scores, ids = scores[hit], bucket.ids[at[hit]]
            for j, (low, high) in enumerate(bands):
                inside = (scores >= max(low, floors[j])) & (scores <= high)
                if inside.any():
                    s, i = (np.concatenate(x) for x in zip(best[j], (scores[inside], ids[inside]), strict=True))
                    order = np.lexsort((i, -s))[:k]
                    best[j] = s[order], i[order]
                    if len(order) == k:
                        floors[j] = max(low, int(s[order[-1]]))
    return best


def compared(candidates: pa.Table, anchors: pa.Table, k: int, other: bool) -> pa.Table:
    """`node, band, id, score`: the best rows of a block for each band of each anchor."""
    out: list[tuple[np.ndarray, ...]] = []
    if candidates.num_rows and anchors.num_rows:
        buckets = index(candidates)
        flat, begin, size = _rows(anchors.column("weights"))
        for i, (node, own, label, bands) in enumerate(zip(*(
                anchors.column(c).to_pylist() for c in ("node", "id", "label", "bands")), strict=True)):
            found = search(buckets, flat[begin[i]:begin[i] + size[i]], own, label, other,
                           [(b["low"], b["high"]) for b in bands], k)
            out += [(np.full(len(s), node), np.full(len(s), band["high"]), ids, s)
                    for band, (s, ids) in zip(bands, found, strict=True)]
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
    return pa.table(dict(zip(("node", "band", "id", "score"), map(pa.array, columns), strict=True)))


def _best(left: DataFrame, right: DataFrame, cell: list[str], cells: int, k: int, other: bool) -> DataFrame:
    """The k best rows of each band of each anchor, from all cells; a cell is a group of each side."""
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(4 * cells, 1 << 16))
    found = left.repartition(tasks, *cell).groupBy(*cell).cogroup(right.repartition(tasks, *cell).groupBy(*cell)).applyInArrow(
        lambda a, b: compared(a, b, k, other), "node long, band long, id long, score long")
    merge = Window.partitionBy("node", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(merge)).where(F.col("rank") <= k)


def _spread(count: str, held: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(count) / held)).cast("int")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80,
         key: str = "vec_id", label: str = "label", weights: str = "weights") -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    A row's score is its inner product with the anchor; higher scores come first, ties by smaller key. An anchor's
    positives are its first rows of the same label; to each belong the first `negatives` rows of other labels with
    a score of `least` per cent of the positive's or more, and not above it. Rows whose key is the anchor's own are
    neither. `weights` are arrays of longs without nulls; vectors of different lengths are compared as if filled up with zeros,
    and an empty vector scores 0. Rows with a null key, label or vector take no part. Repeated rows count
    one by one; rows with one key are anchors of their own. Fewer rows than asked for are all returned, and a pair
    without negatives returns none. Scores are exact while they fit in a long. Other columns are not read.
    `vectors` is read several times and must give the same rows each time.

    Positives are searched in the blocks of the anchor's label, negatives in all blocks whose vectors are long
    enough. Blocks and anchors are dealt evenly, whatever their labels, keys and lengths; each pair of a
    block and a lot of anchors is one group, which ends with a few rows for each anchor.
    """
    norm = F.sqrt(F.aggregate("weights", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(weights).alias("weights"), is_anchor.alias("asked")).where(
        "id is not null and label is not null and weights is not null").select("*", norm.alias("norm"))
    dealt = rows.withColumn("n", F.monotonically_increasing_id())
    anchors = stored(dealt.where("asked").select(F.col("n").alias("node"), "id", "label", "weights", "norm"))

    # positives: within the label
    parts = rows.groupBy("label").agg(F.count("*").alias("c"), F.count(F.when(F.col("asked"), 1)).alias("a")).where("a > 0").select(
        "label", _spread("c", BLOCK).alias("blocks"), _spread("a", ASKED).alias("lots"))
    own = lookup(dealt, parts, "label", "inner").select(
        "id", "label", "weights", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"))
    whole = F.array(F.struct(F.lit(NO_FLOOR).cast("long").alias("low"), F.lit(NO_CEILING).cast("long").alias("high")))
    asking = lookup(anchors, parts, "label", "inner").select(
        "node", "id", "label", "weights", whole.alias("bands"), F.pmod(F.xxhash64("node"), F.col("lots")).cast("int").alias("lot"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    cells = parts.agg(F.sum(F.col("blocks") * F.col("lots"))).first()[0] or 0
    near = stored(_best(own, asking, ["label", "block", "lot"], cells, positives, False).select(
        "node", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    # negatives: in every class of length that a band reaches
    count = rows.count()
    classes = max(1, min(CLASSES, math.ceil(count / BLOCK)))
    cuts = rows.agg(F.percentile_approx("norm", [i / classes for i in range(1, classes)] or [0.5], 10000)).first()[0] or []
    bounds = F.array(*(F.lit(float(c)) for c in sorted(set(cuts), reverse=True))).cast("array<double>")
    classed = dealt.withColumn("class", F.size(F.filter(bounds, lambda b: b > F.col("norm"))))
    held = classed.groupBy("class").agg(F.count("*").alias("c"), F.max("norm").alias("reach")).select(
        "class", "reach", _spread("c", BLOCK).alias("blocks")).collect()  # CLASSES rows at most
    share, rest = f"positive_score div 100 * {least}", f"(positive_score % 100 * {least} + 99) div 100"
    bands = near.where("positive_score >= 0").groupBy("node").agg(F.collect_set(F.struct(
        F.expr(f"{share} + {rest}").alias("low"), F.col("positive_score").alias("high"))).alias("bands"))
    asking = anchors.join(bands, "node")
    lots = max(1, math.ceil(anchors.count() / ASKED))
    table = F.array(*(F.struct(F.lit(r["class"]).alias("class"), F.lit(float(r["reach"])).alias("reach"),
                               F.lit(r["blocks"]).alias("blocks")) for r in held))
    if not held:
        return _empty(vectors)
    floor = F.array_min(F.transform("bands", lambda b: b["low"]))
    reached = asking.select("*", floor.alias("floor")).select(
        "node", "id", "label", "weights", "bands", F.pmod(F.xxhash64("node"), F.lit(lots)).cast("int").alias("lot"),
        F.explode(F.filter(table, lambda c: F.col("floor") <= F.col("norm") * c["reach"] * (1 + SLACK))).alias("to")).select(
        "node", "id", "label", "weights", "bands", "lot", F.col("to")["class"].alias("class"),
        F.explode(F.sequence(F.lit(0), F.col("to")["blocks"] - 1)).alias("block"))
    blocks = F.element_at(F.create_map(*(x for r in held for x in (F.lit(r["class"]), F.lit(r["blocks"])))), F.col("class"))
    all_rows = classed.select("id", "label", "weights", "class", F.pmod(F.xxhash64("n"), blocks).cast("int").alias("block"),
                              F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"))
    far = _best(all_rows, reached, ["class", "block", "lot"], lots * sum(r["blocks"] for r in held), negatives, True)
    pairs = near.join(anchors.select("node", F.col("id").alias("anchor_id")), "node")
    return pairs.join(far.select("node", F.col("band").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
                                 F.col("score").alias("negative_score")), ["node", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _empty(frame: DataFrame) -> DataFrame:
    return frame.sparkSession.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
