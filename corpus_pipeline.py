"""Stages that turn documents into packed training sequences."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm import jaccard, passages, queries, secrets, toxicity
from comptoir.llm.shared import free_name, small_batches, stored

#: A machine that is fitted on labels cannot be written in SQL.
ORACLE_SQL = None
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below TOXIC."""
    model, score = queries.toxicity_model(spark, docs, sf_dir), free_name(docs, "score")
    return toxicity.score(docs, model, column=score).where(F.col(score) < TOXIC).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every class of near duplicates."""
    return jaccard.representatives(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; texts without such passages stay as they are."""
    cut = passages.deduplicated(docs)
    return _with_text(docs.columns, cut, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    return _with_text(docs.columns, secrets.redact(docs), F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each a sequence of power-of-two length."""
    return queries.packed(docs)


def _with_text(columns: list[str], docs: DataFrame, text) -> DataFrame:
    out = docs.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*(F.col(f"`{c}`") for c in columns))


def lean(stage):
    """The stage, its rows going to Python in small batches: the stages share executors whose memory the ones before have touched."""

    @wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return begun


STAGES = [(name, lean(stage)) for name, stage in (
    ("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_duplicates), ("substring dedup", cut_passages),
    ("secret scans", hide_secrets), ("packing", pack))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each stored before the next reads it."""
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
