"""Folders of a session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Shuffles leave the disks of the executors as soon as their job has ended, not when the driver happens to collect its garbage.
SHUFFLES_FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _located(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop_path = _located(spark, path)
    return filesystem.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """Path with the scheme Spark would add, for tasks that open files themselves."""
    filesystem, hadoop_path = _located(spark, path)
    return filesystem.makeQualified(hadoop_path).toString()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, or below those that a pattern names."""
    filesystem, hadoop_path = _located(spark, path)
    return sum(filesystem.getContentSummary(found.getPath()).getLength() for found in filesystem.globStatus(hadoop_path) or ())


def remove(spark: SparkSession, path: str) -> None:
    """A folder and all that is in it; nothing if it is not there."""
    filesystem, hadoop_path = _located(spark, path)
    filesystem.delete(hadoop_path, True)


def work_folder(spark: SparkSession) -> str:
    """New folder for intermediate tables, in the shared folder the cluster names.

    Without ``spark.checkpoint.dir`` a local session uses this machine's temporary folder, and a
    cluster is told to name one. The folder is gone when the application ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file:" + tempfile.gettempdir()
    folder = f"{qualified(spark, shared)}/comptoir-{uuid.uuid4().hex}"
    filesystem, hadoop_path = _located(spark, folder)
    filesystem.mkdirs(hadoop_path)
    filesystem.deleteOnExit(hadoop_path)
    return folder


def at_once(spark: SparkSession, steps: list[Callable[[], None]]) -> None:
    """Steps that do not need each other, run side by side: tasks of one take the cores that the last tasks of another leave.

    All have ended when this returns; the first error is raised then.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session while the block runs."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
