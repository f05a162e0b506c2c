"""Typed inputs, the prediction log, and measures taken from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import coercion, text, traffic
from tidemark.functions.stats import psi_term, share
from tidemark.operators.scans import running_max
from tidemark.operators.slices import positional_slices
from tidemark.runtime import settled


def typed_inputs(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per request and declared feature with the value read by the declared type.

    ``requests``: ``request_id``, ``model_id``, ``features`` (map of texts).
    """
    declared = registry.select("model_id", F.explode("expected_features").alias("feature"))
    raw = F.col("features")[F.col("feature.name")]
    return (
        requests.join(declared, "model_id")
        .select(
            "request_id",
            "model_id",
            F.col("feature.index").alias("index"),
            F.col("feature.name").alias("feature_name"),
            coercion.declared_input(raw, F.col("feature.type")).alias("read"),
        )
        .select("request_id", "model_id", "index", "feature_name", "read.*")
    )


def guessed_inputs(requests: DataFrame) -> DataFrame:
    """One row per request and given input with the type guessed from its text."""
    return requests.select(
        "request_id", F.explode("features").alias("feature_name", "raw")
    ).select(
        "request_id",
        "feature_name",
        "raw",
        coercion.guessed_kind(F.col("raw")).alias("kind"),
        coercion.guessed_number(F.col("raw")).alias("number"),
    )


def log_rows(predictions: DataFrame, at: Column) -> DataFrame:
    """Prediction log rows from ``model_id``, ``model_version``, ``inputs``, ``prediction``, ``error``."""
    return predictions.select(
        "model_id",
        "model_version",
        text.sorted_map_json(F.col("inputs")).alias("model_inputs"),
        text.result_text(F.col("prediction")).alias("model_result"),
        F.coalesce("error", F.lit("")).alias("model_error"),
        at.alias("event_datetime"),
    )


def error_rates(log: DataFrame) -> DataFrame:
    failed = F.coalesce(F.col("model_error") != "", F.lit(False))
    return log.groupBy("model_id", "model_version").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(failed).alias("failures"),
        F.avg(failed.cast("double")).alias("error_rate"),
    )


def prediction_slices(log: DataFrame) -> DataFrame:
    """Slices of the model results, so that output drift runs like feature drift."""
    results = log.filter(F.coalesce(F.col("model_error"), F.lit("")) == "").select(
        "model_id",
        F.col("model_result").try_cast("double").alias("value"),
        F.col("event_datetime").alias("event_timestamp"),
        F.col("event_datetime").alias("created_at"),
    )
    return positional_slices(results, group="model_id")


def canary_split(entities: DataFrame, percent: int, entity: str = "entity_id") -> DataFrame:
    """Each entity's arm; the same entity always gets the same one."""
    return entities.withColumn("arm", traffic.canary_arm(F.col(entity), percent))


def with_labels(predictions: DataFrame, labels: DataFrame, key: str, max_lag: Column) -> DataFrame:
    """Predictions with the first label that arrived within the lag; null when none has.

    Every prediction is one row, however many labels its key has, and may have columns of any type. Of labels that
    arrive at the same instant the smallest is taken. ``predictions`` has ``predicted_at``, ``labels`` has
    ``labeled_at`` and ``label``. The nearest label is found by a scan with time running backwards, so a key with very
    many labels is neither paired with its predictions nor held in one task.
    """
    known = labels.dropna(subset=[key, "labeled_at"])
    arrived = known.select(F.col(key).alias("label_key"), (-F.unix_micros("labeled_at")).alias("at"))
    points = arrived.distinct().withColumn("state", F.col("at"))
    asks = predictions.select(F.col(key).alias("label_key"), (-F.unix_micros("predicted_at")).alias("at"))
    nearest = running_max(points, asks, ["label_key"]).filter(F.col("state").isNotNull())
    # One label per key and instant.
    single = known.groupBy(F.col(key).alias("label_key"), (-F.unix_micros("labeled_at")).alias("state")).agg(
        F.min("label").alias("label"), F.min("labeled_at").alias("labeled_at")
    )
    found = nearest.join(single, ["label_key", "state"]).select("label_key", F.col("at").alias("asked_at"), "label", "labeled_at")
    same = (predictions[key] == found["label_key"]) & (-F.unix_micros(predictions["predicted_at"]) == found["asked_at"])
    in_time = found["labeled_at"] <= predictions["predicted_at"] + max_lag
    return predictions.join(found, same & in_time, "left").select(
        *[predictions[name] for name in predictions.columns], found["label"], found["labeled_at"]
    )


def label_metrics(labeled: DataFrame, by: str = "model_id") -> DataFrame:
    """Accuracy, precision, recall and F1 of binary predictions that have a label."""
    hit = F.col("label").isNotNull()
    said, was = F.col("predicted") == 1, F.col("label") == 1
    counts = labeled.filter(hit).groupBy(by).agg(
        F.count(F.lit(1)).alias("labeled"),
        F.count_if(said & was).alias("tp"),
        F.count_if(said & ~was).alias("fp"),
        F.count_if(~said & was).alias("fn"),
        F.count_if(~said & ~was).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole)

    return counts.select(
        by,
        "labeled",
        "tp",
        "fp",
        "fn",
        "tn",
        ((tp + F.col("tn")) / F.col("labeled")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def label_shares(labels: DataFrame, period: Column) -> DataFrame:
    """Share of each label value per period."""
    counts = labels.groupBy(period.alias("period"), "label").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("period").agg(F.sum("n").alias("total"))
    return counts.join(totals, "period").select(
        "period", "label", "n", (F.col("n") / F.col("total")).alias("share")
    )


def label_psi(labels: DataFrame, period: Column) -> DataFrame:
    """PSI of the label shares of each period against the period before it that has labels.

    Rows ``period``, ``before``, ``n``, ``n_before``, ``psi``; the first period has none. Unlabelled rows are left out.
    Counts per period and label are small; only they are compared.
    """
    counts, _ = settled(labels.where(F.col("label").isNotNull()).groupBy(period.alias("period"), "label").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("period").agg(F.sum("n").alias("total"))
    ordered = totals.withColumns(
        # One row per period.
        {"before": F.lag("period").over(Window.orderBy("period")), "total_before": F.lag("total").over(Window.orderBy("period"))}
    ).where("before IS NOT NULL")
    now = ordered.join(counts, "period").select("period", "label", F.col("n").alias("curr"), F.lit(0).alias("hist"))
    old = ordered.join(counts.withColumnRenamed("period", "before"), "before").select("period", "label", F.lit(0).alias("curr"), F.col("n").alias("hist"))
    both = now.unionByName(old).groupBy("period", "label").agg(F.sum("curr").alias("curr"), F.sum("hist").alias("hist")).join(ordered, "period")
    term = psi_term(share(F.col("curr"), F.col("total")), share(F.col("hist"), F.col("total_before")))
    return both.groupBy("period", "before", F.col("total").alias("n"), F.col("total_before").alias("n_before")).agg(F.sum(term).alias("psi"))
