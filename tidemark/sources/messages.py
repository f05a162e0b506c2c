"""Event messages: JSON text in, typed rows and dead letters out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import rfc3339
from tidemark.runtime import once

_TEXT_EVENT = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("validated_at", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("broken", T.StringType()),
    ]
)


def event_stream(spark: SparkSession, format: str, options: dict[str, str]) -> DataFrame:
    """Stream of messages with a text column ``value``.

    ``kafka`` needs its connector on the class path and delivers bytes; ``text`` reads a folder
    of line files.
    """
    stream = spark.readStream.format(format).options(**options).load()
    return stream.withColumn("value", F.col("value").cast("string"))


def parse_messages(messages: DataFrame, body: str = "value") -> DataFrame:
    """Messages with their parsed fields and an ``error`` for those that cannot be used.

    A message is refused when it is no JSON object of the expected types or when a time is not
    RFC 3339. Nothing is raised: refused messages go to the dead letters.
    """
    event = F.from_json(
        F.col(body),
        _TEXT_EVENT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"},
    )
    parsed = messages.select("*", once(event).alias("event"))
    timed = parsed.select(
        "*",
        once(
            F.struct(
                rfc3339(F.col("event.validated_at")).alias("event_timestamp"),
                rfc3339(F.col("event.created_at")).alias("created_at"),
            )
        ).alias("times"),
    )
    unread = F.col("event.created_at").isNotNull() & F.col("times.created_at").isNull()
    error = (
        F.when(F.col("event").isNull() | F.col("event.broken").isNotNull(), "not a JSON event")
        .when(F.col("times.event_timestamp").isNull(), "bad event time")
        .when(unread, "bad creation time")
    )
    return timed.select(
        *messages.columns,
        "event.entity_id",
        "event.feature_name",
        F.col("event.value").alias("event_value"),
        "times.event_timestamp",
        "times.created_at",
        error.alias("error"),
    )


def good_events(parsed: DataFrame) -> DataFrame:
    """Rows for the feature log; the message's validation time is the event time."""
    return parsed.filter(F.col("error").isNull()).select(
        "entity_id",
        "feature_name",
        F.col("event_value").alias("value"),
        "event_timestamp",
        "created_at",
    )


def dead_letters(parsed: DataFrame, body: str = "value") -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select(F.col(body).alias("message"), "error")


def to_log(events: DataFrame) -> DataFrame:
    """Events from files as log rows."""
    return events.select(
        "entity_id",
        "feature_name",
        "value",
        F.col("validated_at").alias("event_timestamp"),
        "created_at",
    )
