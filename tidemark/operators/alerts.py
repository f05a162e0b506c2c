"""Threshold alerts, three-sigma flags and the cooldown between alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import finite_double
from tidemark.operators.scans import running_max
from tidemark.runtime import join_side, stored, written

# Alert threshold, pause after an alert.
THRESHOLD = 100.0
COOLDOWN_SECONDS = 600


def threshold_candidates(log: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Events above the threshold, strictly."""
    return log.filter(F.col("value") > F.lit(float(threshold)))


def first_alert(batch: DataFrame, by: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """First event above the threshold of each batch: by time, then by its id where events have one, then by its values."""
    known = [c for c in ("event_timestamp", "event_id", "entity_id", "feature_name", "value") if c in batch.columns]
    first = F.min(F.struct(*known))
    return (
        threshold_candidates(batch, threshold)
        .groupBy(*by)
        .agg(first.alias("first"))
        .select(*by, "first.*")
    )


def three_sigma(log: DataFrame) -> DataFrame:
    """Events more than three sample deviations above the mean of their feature."""
    number = finite_double(F.col("value"))
    limits = join_side(
        log.groupBy("feature_name").agg(
            (F.avg(number) + 3 * F.stddev_samp(number)).alias("upper_limit")
        )
    )
    return log.join(limits, "feature_name").filter(F.col("value") > F.col("upper_limit"))


def cooldown_alerts(
    candidates: DataFrame,
    key: str = "entity_id",
    time: str = "event_timestamp",
    cooldown_seconds: int = COOLDOWN_SECONDS,
) -> DataFrame:
    """Alert times per key: after an alert, candidates within the cooldown are passed over.

    Which candidates alert depends on all earlier alerts of the key, but the candidate that would
    follow one does not: it is the first of the key later than its cooldown. These successors come from one
    scan over all keys. Successors 2, 4, 8, ... alerts ahead come from joining a table of successors with itself; the
    alerts are then what the first candidate of each key reaches, marked from the longest steps to the shortest.
    All joins are on (key, time), of which there is one row, so a key of any size is spread like any other rows.
    """
    pause = cooldown_seconds * 1_000_000
    moments = stored(
        candidates.select(F.col(key).alias("k"), F.unix_micros(time).alias("t"))
        .filter(F.col("k").isNotNull() & F.col("t").isNotNull())
        .distinct(),
        "moments",
    )
    # Time runs backwards here: the largest state before the end of a cooldown is the first candidate after it.
    points = moments.select("k", (-F.col("t")).alias("at"), (-F.col("t")).alias("state"))
    ends = moments.select("k", (-F.col("t") - pause).alias("at"))
    next_after = running_max(points, ends, ["k"], strict=True)
    step = next_after.filter(F.col("state").isNotNull()).select("k", (-F.col("at") - pause).alias("t"), (-F.col("state")).alias("after"))
    steps, count = [], 1
    while count:
        step, facts = written(step, "steps")
        count = facts["rows"]
        if count:
            steps.append(step)
            further = step.select("k", F.col("t").alias("after"), F.col("after").alias("beyond"))
            step = step.join(further, ["k", "after"]).select("k", "t", F.col("beyond").alias("after"))
    marked = moments.groupBy("k").agg(F.min("t").alias("t"))
    for step in reversed(steps):
        marked = stored(marked, "marked")
        # Steps of one length from different alerts end at different ones.
        marked = marked.unionByName(marked.join(step, ["k", "t"]).select("k", F.col("after").alias("t")))
    return marked.select(F.col("k").alias(key), F.timestamp_micros("t").alias("alert_time"))
