"""Rules for sales events; the same functions serve streams and batch DataFrames."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir import schemas as S
from comptoir.functions import city_standard, line_amount


def raw_messages(messages: DataFrame) -> DataFrame:
    """Messages as received, with where and when they were."""
    return messages.select(
        F.col("value").cast("string").alias("message"), "partition", "offset",
        F.col("timestamp").cast("string").alias("kafka_timestamp"))


def parse_events(messages: DataFrame) -> DataFrame:
    """Contract fields next to every message; a field that does not fit is null, nothing fails.

    Expanded by a generator: as a plain struct expression the parse would be repeated for every
    field that a later filter looks at.
    """
    parsed = F.from_json("message", S.EVENT_SCHEMA)
    return raw_messages(messages).select("*", F.inline(F.array(parsed)))


def event_time() -> Column:
    return F.try_to_timestamp("horodatage")


def conforming() -> Column:
    """All required fields there, amounts positive, time readable.

    The time is part of the rule: one unreadable time must not stop the stream.
    """
    complete = reduce(and_, [F.col(name).isNotNull() for name in S.EVENT_REQUIRED])
    positive = (F.col("quantite") > 0) & (F.col("prix_unitaire") > 0)
    return complete & positive & event_time().isNotNull()


def judge_events(messages: DataFrame) -> DataFrame:
    return parse_events(messages).withColumn("conforme", F.coalesce(conforming(), F.lit(False)))


def rejected_events(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col("conforme")).select("message", "partition", "offset")


def valid_events(judged: DataFrame) -> DataFrame:
    return judged.where("conforme").drop("message", "kafka_timestamp", "conforme")


def typed_events(valid: DataFrame) -> DataFrame:
    """City, time, sale date and amount by the rules of the batch."""
    return valid.withColumns({
        "ville": city_standard(F.col("ville")),
        "horodatage": event_time(),
        "date_vente": F.to_date(event_time()),
        "montant": line_amount(F.col("quantite"), F.col("prix_unitaire")),
    })


def batch_statistics(judged: DataFrame) -> DataFrame:
    """Per source partition: offset range, messages received, valid and rejected."""
    return judged.groupBy("partition").agg(
        F.min("offset").alias("premier_offset"),
        F.max("offset").alias("dernier_offset"),
        F.count(F.lit(1)).alias("recus"),
        F.count_if("conforme").alias("valides"),
        F.count_if(~F.col("conforme")).alias("rejetes"))
