"""Filters, quality checks and reshaping of the feature log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import finite_double
from tidemark.operators.buckets import fitting_unit
from tidemark.runtime import join_side


def of_feature(log: DataFrame, feature: str) -> DataFrame:
    """Rows of one feature; prunes partitions when the log is partitioned by feature."""
    return log.filter(F.col("feature_name") == feature)


def feature_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("feature_name").agg(F.count(F.lit(1)).alias("n"))


def basic_statistics(log: DataFrame, value: str = "value") -> DataFrame:
    """Mean, sample variance and sample deviation of the numeric values of each feature.

    A feature without any number gets zeros; with exactly one, variance and deviation are null.
    """
    number = finite_double(F.col(value))
    n = F.count(number)
    zero = F.lit(0.0)
    return log.groupBy("feature_name").agg(
        n.alias("n"),
        F.coalesce(F.avg(number), zero).alias("mean"),
        F.when(n == 0, zero).otherwise(F.var_samp(number)).alias("variance"),
        F.when(n == 0, zero).otherwise(F.stddev_samp(number)).alias("std"),
    )


def null_rates(log: DataFrame, value: str = "value") -> DataFrame:
    """Share of missing values and share of values that are no number, per feature."""
    return log.groupBy("feature_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(value).isNull().cast("double")).alias("null_rate"),
        F.avg(finite_double(F.col(value)).isNull().cast("double")).alias("unusable_rate"),
    )


def trailing_interval(
    log: DataFrame, interval: Column, as_of: Column | None = None, time: str = "event_timestamp"
) -> DataFrame:
    """Rows newer than ``as_of`` minus the interval, strictly.

    The default ``as_of`` is the newest event, as a scalar subquery, so that a second run over
    the same log gives the same rows and the bound still reaches the scan.
    """
    if as_of is None:
        return log.filter(F.col(time) > log.select(F.max(time)).scalar() - interval)
    return log.filter((F.col(time) > as_of - interval) & (F.col(time) <= as_of))


def validate(events: DataFrame, known_features: DataFrame) -> DataFrame:
    """Events with a ``reason``: null for a valid one, else the first rule it breaks.

    ``known_features`` holds ``feature_name``; an event of any other feature is refused.
    """
    known = join_side(known_features.select("feature_name").distinct().withColumn("known", F.lit(True)))
    checked = events.join(known, "feature_name", "left")
    reason = (
        F.when(F.col("entity_id").isNull() | (F.col("entity_id") == ""), "missing entity")
        .when(F.col("feature_name").isNull(), "missing feature")
        .when(F.col("known").isNull(), "unknown feature")
        .when(finite_double(F.col("value")).isNull(), "value is no number")
    )
    return checked.withColumn("reason", reason).drop("known")


def critical_only(events: DataFrame, critical: DataFrame) -> DataFrame:
    """Events of the features marked critical: the ones the online view keeps."""
    return events.join(
        join_side(critical.select("feature_name").distinct()), "feature_name", "left_semi"
    )


def from_actions(actions: DataFrame) -> DataFrame:
    """Raw user actions ``(user_id, action, timestamp, payload)`` as feature rows.

    The value is the payload's ``k`` field; the action is the feature name.
    """
    return actions.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("entity_id"),
        F.col("action").alias("feature_name"),
        F.get_json_object("payload", "$.k").try_cast("double").alias("value"),
        F.col("timestamp").alias("event_timestamp"),
        F.col("timestamp").alias("created_at"),
    )


def entity_vector(online: DataFrame, features: list[tuple[int, str]]) -> DataFrame:
    """Wide row per entity, one column per declared feature, in the order of its index.

    The names are given, so the pivot needs no pass to find them; a feature without a value is
    null. Only the wanted features are read.
    """
    names = [name for _, name in sorted(features)]
    wanted = online.filter(F.col("feature_name").isin(names))
    return wanted.groupBy("entity_id").agg(
        *[F.max(F.when(F.col("feature_name") == name, F.col("value"))).alias(name) for name in names]
    )


def trailing_counts(
    log: DataFrame,
    days: int,
    keys: tuple[str, ...] = ("entity_id", "feature_name"),
    bucket: str | None = None,
) -> DataFrame:
    """The rows of the log with ``trailing_count``: how many rows of the key fall in the ``days`` up to it, itself included.

    ``count(<= t) - count(< t - days)``, each as rows before the bucket plus rows within it. A
    window over a whole key would sort it in one task; here a task holds one bucket of a key
    (a day, or less where a key is too dense), and the sums before it come from a small table
    of counts per bucket. Rows of a key at the same instant share their count, so they are counted
    once, map-side: an instant with very many rows is one row of the window. Repeated rows count
    each; rows without a key or a time have no count (null).
    """
    keys = list(keys)
    time = F.col("event_timestamp")
    back = F.make_dt_interval(F.lit(days))
    unit = bucket or fitting_unit(log, keys, "event_timestamp")
    known = log.dropna(subset=[*keys, "event_timestamp"])
    instants = known.groupBy(*keys, time.alias("instant")).agg(F.count(F.lit(1)).alias("rows"))
    marks = F.array(
        F.struct(F.col("instant").alias("at"), F.col("rows").alias("rows"), F.lit(1).alias("sign")),
        F.struct((F.col("instant") - back).alias("at"), F.lit(0).cast("bigint").alias("rows"), F.lit(-1).alias("sign")),
    )
    points = instants.select(*keys, "instant", F.inline(marks)).withColumn("bucket", F.date_trunc(unit, "at"))
    # A probe sorts before the rows of its instant, since the window includes its lower end.
    within = Window.partitionBy(*keys, "bucket").orderBy(F.struct("at", "sign"))
    counted = points.withColumn("seen", F.sum("rows").over(within))
    filled = points.groupBy(*keys, "bucket").agg(F.sum("rows").alias("arrived"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = filled.select(
        *keys, "bucket", F.coalesce(F.sum("arrived").over(earlier), F.lit(0)).alias("base")
    )
    counts = (
        counted.join(base, [*keys, "bucket"])
        .groupBy(*keys, F.col("instant").alias("event_timestamp"))
        .agg(F.sum(F.col("sign") * (F.col("base") + F.col("seen"))).alias("trailing_count"))
    )
    return log.join(counts, [*keys, "event_timestamp"], "left").select(*log.columns, "trailing_count")
