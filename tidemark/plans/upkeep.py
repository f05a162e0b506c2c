"""Backfill of derived features and their lineage rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import trailing_counts
from tidemark.sinks.days import DayTable

LOG_COLUMNS = ["entity_id", "feature_name", "value", "event_timestamp", "created_at"]


def transformed(log: DataFrame, name: str, feature: str, expression: Callable[[Column], Column]) -> DataFrame:
    """A derived feature row by row, for example twice the value."""
    return log.filter(F.col("feature_name") == feature).withColumns(
        {"feature_name": F.lit(name), "value": expression(F.col("value"))}
    )


def transformed_in_batches(
    log: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame]
) -> DataFrame:
    """Any Python transform of event batches that keeps the columns; Arrow batches, no rows."""

    def over(batches):
        for batch in batches:
            yield function(batch)

    return log.mapInPandas(over, log.schema)


def trailing_feature(log: DataFrame, days: int) -> DataFrame:
    """``<feature>_<days>d``: how often the feature occurred in the days up to each event."""
    counted = trailing_counts(log, days).withColumns(
        {
            "feature_name": F.concat(F.col("feature_name"), F.lit(f"_{days}d")),
            "value": F.col("trailing_count").cast("double"),
            "created_at": F.col("event_timestamp"),
        }
    )
    return counted.drop("trailing_count")


def lineage_rows(edges: DataFrame, transform_version: str) -> DataFrame:
    """Edge rows ``output``, ``input`` with the version of the transform that made them."""
    return edges.select("output", "input").distinct().withColumn(
        "transform_version", F.lit(transform_version)
    )


def backfill(
    log: DataFrame,
    first: date,
    until: date,
    derive: Callable[[DataFrame], DataFrame],
    table: DayTable,
    look_back: Column | None = None,
    features: list[str] | None = None,
) -> None:
    """Derive features for the days from ``first`` to before ``until`` and replace these days of ``table`` in one step.

    ``derive`` sees the log up to ``until``, from ``look_back`` (an interval) before ``first`` if it
    is given: a trailing feature needs that much of the past. Only rows of these days are
    written; a feature and day of the table for which nothing was derived loses its rows. Without ``features`` the table
    holds what ``derive`` makes and nothing else. A second run leaves the same rows.
    """
    start, end = F.lit(first).cast("timestamp"), F.lit(until).cast("timestamp")
    read = log.filter(F.col("event_timestamp") < end)
    if look_back is not None:
        read = read.filter(F.col("event_timestamp") >= start - look_back)
    within = (F.col("event_timestamp") >= start) & (F.col("event_timestamp") < end)
    table.replace(derive(read).filter(within), first, until, features)
