"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows each partition sends to each shard is drawn first, exactly as a uniform permutation
of all rows would have it; then partitions permute locally, exchange, and shards permute again.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm.shared import checkpointed

#: Rows that the second permutation orders together, on average.
BLOCK_ROWS = 4096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` from `good` + `bad` without replacement are good, by inversion.

    The window holds all but about 1e-30 of the probability.
    """
    low, high = max(0, draws - bad), min(good, draws)
    share = good / max(good + bad, 1)
    reach = 12 * math.sqrt(draws * share * (1 - share)) + 24
    low, high = max(low, math.floor(draws * share - reach)), min(high, math.ceil(draws * share + reach))
    x = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - x) + np.log(draws - x) - np.log(x + 1) - np.log(bad - draws + x + 1)
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    total = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(total, rng.random() * total[-1], "right").clip(0, high - low))


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Rows sent from each partition to each shard; sums are `rows` and `shards` exactly."""
    rng, left = np.random.default_rng([seed, len(rows), len(shards)]), list(shards)
    out = np.zeros((len(rows), len(shards)), np.int64)
    for i, draws in enumerate(rows):
        rest = sum(left)
        for j, size in enumerate(left):
            rest -= size
            out[i, j] = hypergeometric(rng, size, rest, draws)
            draws -= int(out[i, j])
        left = [a - int(b) for a, b in zip(left, out[i], strict=True)]
    return out


def shuffled(frame: DataFrame, shards: int = 8, seed: int = 0, stable: bool = False) -> DataFrame:
    """The frame with `shard` and `slot`, a uniform shuffle into shards whose sizes differ by one at most.

    Every row counts, whatever its values: null, equal and repeated rows have places of their own.
    An empty frame gives an empty frame. Columns named `shard` or `slot` are replaced; others stay.
    A task that is run again must see the same rows in the same order, to draw the same numbers: a `stable` frame gives them,
    as the scan of a stored table does; any other is stored in the shared folder first. Each row is shuffled once, whole.
    """
    spark = frame.sparkSession
    kept = [c for c in frame.columns if c not in ("shard", "slot")]
    names = [f"_{i}" for i in range(len(kept))]
    fixed = frame.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)))
    fixed = fixed if stable else checkpointed(fixed)
    counted = dict(fixed.groupBy(F.spark_partition_id().alias("part")).count().collect())
    order = sorted(counted)
    total = sum(counted.values())
    sizes = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = communication_matrix([counted[p] for p in order], sizes, seed)
    sent = spark.sparkContext.broadcast(dict(zip(order, matrix, strict=True)))
    bits = max(0, math.ceil(math.log2(max(total, 1) / shards / BLOCK_ROWS)))

    def deal(batches):
        partition, at = TaskContext.get().partitionId(), 0
        rng = np.random.default_rng([seed, 1, partition])
        to = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if to is None:
                to = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), sent.value[partition]))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(to[at:at + n]), pa.array(rng.integers(0, 1 << 62, n)),
                 pa.array(np.arange(at, at + n) + (partition << 33))], [*batch.schema.names, "shard", "draw", "row"])
            at += n

    def dealt(rows: DataFrame) -> DataFrame:
        schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields)
        return rows.mapInArrow(deal, schema + "shard int, draw long, row long").withColumn(
            "block", F.shiftright("draw", 62 - bits).cast("int"))

    # the same draws for the counts, without the rows' content
    places = dealt(fixed.select(F.lit(0).alias("nothing"))).groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = places.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("shard", "block").orderBy("draw", "row")
    ranked = dealt(fixed).withColumn("place", F.row_number().over(within)).join(places, ["shard", "block"])
    return ranked.select(*(F.col(n).alias(c) for n, c in zip(names, kept, strict=True)),
                         "shard", (F.col("begin") + F.col("place") - 1).cast("long").alias("slot"))
