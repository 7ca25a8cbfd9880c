"""Exact top-k search by exhaustive term-at-a-time accumulation.

A term is a component of a vector. Candidates are kept as posting lists by term; a query adds its
weight times each posting into a dense array of scores, one cell per candidate of the block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block; with 64 terms, 4 MB of candidates and 16 MB of queries.
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 32768


def whole_weights(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component, as long."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def finite(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    return vector.isNotNull() & F.coalesce(F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))),
        F.lit(False))


def _postings(weights: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms with a posting, where each list begins, and rows and weights of the postings."""
    values = weights.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(weights.offsets.to_numpy())
    row = np.repeat(np.arange(len(lengths)), lengths)
    term = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    full = np.flatnonzero(values)
    order = full[np.argsort(term[full], kind="stable")]
    terms, begins = np.unique(term[order], return_index=True)
    return terms, np.append(begins, len(order)), row[order], values[order]


def accumulate(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best candidates of this block for every query of this block."""
    ids = candidates.column("id").to_numpy()
    terms, begins, rows, weights = _postings(candidates.column("weights").combine_chunks())
    lists = {int(t): (rows[a:b], weights[a:b]) for t, a, b in zip(terms, begins[:-1], begins[1:], strict=True)}
    order = np.argsort(ids, kind="stable")
    ranked = ids[order]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    asked = queries.column("weights").combine_chunks()
    flat, offsets = asked.flatten().to_numpy(zero_copy_only=False), asked.offsets.to_numpy()
    offsets = offsets - offsets[0]
    for query, begin, end in zip(queries.column("id").to_numpy(), offsets[:-1], offsets[1:], strict=True):
        scores = np.zeros(len(ids), np.int64)
        own = flat[begin:end]
        for term in np.flatnonzero(own).tolist():
            if term in lists:
                to, weight = lists[term]
                if len(to) == len(ids):
                    scores += own[term] * weight
                else:
                    scores[to] += own[term] * weight
        left, right = np.searchsorted(ranked, [query, query + 1]) if query < np.iinfo(np.int64).max else (
            np.searchsorted(ranked, query), len(ranked))
        others = np.ones(len(ids), bool)
        others[order[left:right]] = False
        at = np.flatnonzero(others)
        if len(at) > k:  # everything that ties with the k-th score stays until it is ordered
            least = np.partition(scores[at], len(at) - k)[len(at) - k]
            at = at[scores[at] >= least]
        at = at[np.lexsort((ids[at], -scores[at]))[:k]]
        out.append((np.full(len(at), query), ids[at], scores[at]))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
    return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id",
          weights: str = "weights") -> DataFrame:
    """`query_id, rank, vec_id, score`: the k highest inner products, ties to the smaller key.

    `weights` is an array of longs; missing and zero components add nothing. Every row but those
    with the query's own key is a candidate; k candidates or fewer are all returned. Rows with a
    null key or vector take no part. Repeated rows are candidates of their own, and rows that share
    a query's key are ranked together. Scores are exact while they fit in a long. Other columns
    are not read.

    Candidates and queries are dealt evenly into blocks of bounded size, whatever their keys; each
    pair of blocks is one group that ends with k rows for each of its queries, and these are merged.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(weights).alias("weights"),
                          is_query.alias("asked")).where("id is not null and weights is not null")
    sizes = rows.agg(F.count("*"), F.count(F.when(F.col("asked"), 1))).first()
    across, down = max(1, math.ceil(sizes[0] / CANDIDATE_BLOCK)), max(1, math.ceil(sizes[1] / QUERY_BLOCK))
    dealt = rows.withColumn("n", F.monotonically_increasing_id())

    def cells(frame: DataFrame, own: str, blocks: int, other: str, copies: int) -> DataFrame:
        return frame.select("id", "weights", F.pmod(F.xxhash64("n"), F.lit(blocks)).cast("int").alias(own),
                            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))

    candidates = cells(dealt, "a", across, "b", down)
    queries = cells(dealt.where("asked"), "b", down, "a", across)
    best = candidates.groupBy("a", "b").cogroup(queries.groupBy("a", "b")).applyInArrow(
        lambda left, right: accumulate(left, right, k), "query_id long, vec_id long, score long")
    merge = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(merge)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
