"""Reliable checkpoints and stored tables in the folder that the cluster shares."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from comptoir.session import work_folder

BATCH_BYTES = 8 * 1024 * 1024
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame, stored partition by partition in the shared folder, so that its lineage ends here."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(frame.sparkSession))
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written as a compressed table in the shared folder and read again."""
    path = f"{work_folder(frame.sparkSession)}/table"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python, and come back, by BATCH_BYTES at once, unless the session says how many.

    Each task holds several batches, in both of its processes; Spark's own bound is 64 MB.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def widened(frame: DataFrame, function, added: str = "") -> DataFrame:
    """`function` over Arrow batches of all columns of the frame, whatever their names, and columns it adds.

    In the batches the columns are called _0, _1, …; the result has the old names and the added ones.
    """
    plain = frame.toDF(*(f"_{i}" for i in range(len(frame.columns))))
    more = StructType.fromDDL(added).fields if added else []

    def alone(batches):
        sys.__dict__.get("_comptoir_kept", {}).clear()  # what another operator has kept in this worker (`once`)
        return function(batches)

    out = plain.mapInArrow(alone, StructType([*plain.schema.fields, *more]))
    return out.toDF(*frame.columns, *(f.name for f in more))


def free_name(frame: DataFrame, name: str) -> str:
    """The name, or one like it that no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name = f"_{name}"
    return name


def once(key: tuple, make: Callable[[], Any]) -> Any:
    """What `make` gives, made once in a worker process; the tasks of a worker share it, one after the other."""
    kept = sys.__dict__.setdefault("_comptoir_kept", {})  # functions travel by value, so modules keep nothing
    if key not in kept:
        kept.clear()  # one at a time
        kept[key] = make()
    return kept[key]
