"""Message sources: streams of (value, partition, offset, timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.schemas import ENVELOPE_SCHEMA

#: Bytes of the files that a micro-batch of an archive takes.
BATCH_BYTES = 256 * 1024 * 1024
ENVELOPE = ["value", "partition", "offset", "timestamp"]


def kafka_messages(spark: SparkSession, servers: str, topic: str = "ventes",
                   messages_per_batch: int | None = None) -> DataFrame:
    """Messages of a topic, from the earliest on the first start, then from the checkpoint.

    ``messages_per_batch`` keeps the first micro-batch of a long topic from being all of it.
    Needs the spark-sql-kafka-0-10 package on the cluster.
    """
    # Where a first start begins, and that expired messages do not end the stream.
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if messages_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(messages_per_batch)
    return spark.readStream.format("kafka").options(**options).load().select(*ENVELOPE)


def file_messages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same stream from Parquet files of messages, as a replay of an archive.

    A micro-batch holds files of about BATCH_BYTES, so that what its tasks hold and read does not grow with the archive, or
    ``files_per_batch`` files. A larger file is a micro-batch of its own.
    """
    name, most = ("maxBytesPerTrigger", BATCH_BYTES) if files_per_batch is None else ("maxFilesPerTrigger", files_per_batch)
    return spark.readStream.schema(ENVELOPE_SCHEMA).option(name, most).parquet(folder)


def topic_partition(key, partitions: int):
    """Partition of a message key: messages of one key stay in order."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
