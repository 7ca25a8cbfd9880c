"""Joins that stay even when one key holds a large part of the rows, and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

# More partitions than any shuffle has: coalescing to it moves nothing.
NO_PARTITION_LIMIT = 1_000_000


def unclustered(rows: DataFrame) -> DataFrame:
    """The same rows and partitions, without the promise that equal keys are together.

    Adaptive execution splits a hot key only between two shuffles made for the join. A side that
    comes clustered by the key out of a window or an aggregation would skip its shuffle, and
    the hot key of the other side would stay in one task. Likewise an aggregation that could
    build on the clustering of a join keeps that join from being split.
    """
    return rows.coalesce(NO_PARTITION_LIMIT)


def lookup(rows: DataFrame, reference: DataFrame, key: str | list[str], how: str = "left") -> DataFrame:
    """Join many rows with a reference that has few rows per key, skew on the side of the many.

    No hint: Catalyst, and at run time adaptive execution, broadcast the reference if its size
    is below ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are shuffled and the
    partitions of hot keys, null among them, are split.
    """
    return rows.join(unclustered(reference), key, how)


def all_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
