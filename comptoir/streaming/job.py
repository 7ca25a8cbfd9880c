"""The streaming job: raw log, rejects, valid events and cumulative revenue.

Two queries over one stream, each with its own checkpoint. The first writes what every
micro-batch holds; the second keeps the revenue per city and category as state and writes the keys that changed, so
a micro-batch costs what it brings and not what the history holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from comptoir.operators.revenue import MEASURES, revenue_by, revenue_by_axes
from comptoir.plans.batch import CURATED
from comptoir.session import exists
from comptoir.sinks import read_keyed, replace_partition, upsert
from comptoir.streaming import events

EVERY_20_SECONDS = {"processingTime": "20 seconds"}
AVAILABLE_NOW = {"availableNow": True}
#: Rows of a file, at most on average, and bytes of the messages that a task reads to write one.
FILE_ROWS, FILE_BYTES = 1_000_000, 64 * 1024 * 1024
RAW_COLUMNS = ["message", "partition", "offset", "kafka_timestamp"]
HISTORY_SCHEMA = (
    "partition int, offset bigint, schema_version int, id_vente string, horodatage timestamp, "
    "id_caisse string, id_magasin string, ville string, id_client string, id_produit string, "
    "nom_produit string, categorie string, quantite int, prix_unitaire double, date_vente date, "
    "montant double, micro_batch bigint")


def write_batch(messages: DataFrame, batch_id: int, lake: str) -> None:
    """Write one micro-batch; writing it again replaces its own partitions and nothing else.

    Messages are fetched and parsed once for the four outputs. The statistics come first: they fill the cache, tell whether there is
    anything to write, and how many tasks that makes. A task reads messages of all kinds, whichever it writes, so every output is
    dealt by the messages received, their number and their bytes. No output is shuffled.
    """
    judged = events.judge_events(messages).persist()
    try:
        statistics = events.batch_statistics(judged)
        counted = statistics.collect()  # a row per partition of the topic
        tasks = _tasks(judged, sum(r["recus"] for r in counted)) if counted else 1
        outputs = [
            ("raw/ventes_stream", judged.select(*RAW_COLUMNS), "json", "recus"),
            ("raw/rejets_stream", events.rejected_events(judged), "json", "rejetes"),
            ("processed/ventes_stream", events.typed_events(events.valid_events(judged)), "parquet", "valides"),
        ]
        if counted:
            outputs.append(("processed/statistiques_stream", judged.sparkSession.createDataFrame(
                counted, statistics.schema), "parquet", None))
        for table, rows, file_format, count in outputs:
            if count is None or any(r[count] for r in counted):
                replace_partition(rows.coalesce(tasks if count else 1).withColumn("micro_batch", F.lit(batch_id)),
                                  f"{lake}/{table}", "micro_batch", file_format)
    finally:
        judged.unpersist()


def _tasks(judged: DataFrame, received: int) -> int:
    """Tasks that write an output of a micro-batch."""
    octets = judged.agg(F.sum(F.octet_length("message"))).first()[0] or 0
    return max(1, -(-received // FILE_ROWS), -(-octets // FILE_BYTES))


def write_revenue(changed: DataFrame, lake: str) -> None:
    """New totals of the keys that a micro-batch has changed, into the table of each axis."""
    changed = changed.persist()
    try:
        for table, key in CURATED.items():
            upsert(changed.where(F.col("axe") == table).select(F.col("cle").alias(key), *MEASURES),
                   f"{lake}/curated/streaming/{table}", key, revenue_schema(key))
    finally:
        changed.unpersist()


def revenue_schema(key: str) -> str:
    return f"{key} string, nb_ventes bigint, quantite_totale bigint, chiffre_affaires double"


def read_revenue(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """Cumulative revenue of one axis as of the last micro-batch."""
    return read_keyed(spark, f"{lake}/curated/streaming/{table}", revenue_schema(CURATED[table]))


def cumulative_revenue(messages: DataFrame) -> DataFrame:
    """Revenue by city and by category in one aggregation, one state store."""
    typed = events.typed_events(events.valid_events(events.judge_events(messages)))
    return revenue_by_axes(typed, CURATED)


@dataclass(frozen=True)
class SalesStream:
    batches: StreamingQuery
    revenue: StreamingQuery

    def wait(self) -> None:
        """Until both queries have ended; if one fails, the other is stopped and the failure raised."""
        queries = (self.batches, self.revenue)
        try:
            while active := [query for query in queries if query.isActive]:
                active[0].awaitTermination(1)
                self._raise_failure()
        except Exception:
            self.stop()
            raise
        self._raise_failure()

    def _raise_failure(self) -> None:
        for query in (self.batches, self.revenue):
            if query.exception() is not None:
                raise query.exception()

    def stop(self) -> None:
        self.batches.stop()
        self.revenue.stop()


def start_sales_stream(messages: DataFrame, lake: str, checkpoint: str,
                       trigger: dict | None = None) -> SalesStream:
    """Start both queries over a stream of (value, partition, offset, timestamp)."""
    every = trigger or EVERY_20_SECONDS
    batches = (messages.writeStream.queryName("ventes_lots")
               .foreachBatch(lambda rows, batch_id: write_batch(rows, batch_id, lake))
               .option("checkpointLocation", f"{checkpoint}/lots").trigger(**every).start())
    revenue = (cumulative_revenue(messages).writeStream.queryName("ventes_cumul")
               .outputMode("update")
               .foreachBatch(lambda rows, _: write_revenue(rows, lake))
               .option("checkpointLocation", f"{checkpoint}/cumul").trigger(**every).start())
    return SalesStream(batches, revenue)


def read_history(spark: SparkSession, lake: str) -> DataFrame:
    """Valid events of all micro-batches; empty as long as there are none."""
    path = f"{lake}/processed/ventes_stream"
    if not exists(spark, path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def revenue_from_history(spark: SparkSession, lake: str, key: str) -> DataFrame:
    """The cumulative revenue again, from the stored events."""
    return revenue_by(read_history(spark, lake), key)
