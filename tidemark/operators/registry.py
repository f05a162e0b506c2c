"""The model registry: filters, versions, nested feature lists and artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text, versions
from tidemark.runtime import join_side

PRODUCTION = "production"
DEPRECATED = "deprecated"
# The first version and artifact type of a model that was not known before.
FIRST_VERSION = "0.1.0"
FIRST_TYPE = "pkl"


def production_models(registry: DataFrame) -> DataFrame:
    """Rows in production, the date as text and the feature list as JSON."""
    return registry.filter(F.col("status") == PRODUCTION).select(
        "model_id",
        "artifact_type",
        "version",
        text.day_text(F.col("trained_date")).alias("trained_date"),
        "model_drift_score",
        "status",
        "azure_location",
        F.to_json("expected_features").alias("features_json"),
    )


def parsed_features(features_json: Column) -> Column:
    """Feature list behind a JSON text; null when the text cannot be read."""
    return F.from_json(
        features_json,
        "array<struct<index:int,name:string,type:string,drift_score:double>>",
    )


def usable_models(registry: DataFrame) -> DataFrame:
    """Models whose feature list has at least one entry; the others are skipped."""
    return registry.filter(F.coalesce(F.size("expected_features"), F.lit(0)) > 0)


def missing_models(required: DataFrame, registry: DataFrame) -> DataFrame:
    """Required ids that the registry does not have."""
    return required.select("model_id").distinct().join(
        registry.select("model_id").distinct(), "model_id", "left_anti"
    )


def current_versions(registry: DataFrame) -> DataFrame:
    """The row with the highest version of each model, compared part by part as numbers."""
    whole_row = F.struct(*registry.columns)
    return (
        registry.groupBy("model_id")
        .agg(F.max_by(whole_row, F.struct(versions.sort_key(F.col("version")), "created_at")).alias("row"))
        .select("row.*")
    )


def reset_scores(features: Column) -> Column:
    return F.transform(features, lambda f: f.withField("drift_score", F.lit(0.0)))


def retrained_rows(registry: DataFrame, trained: DataFrame, as_of: Column) -> DataFrame:
    """Registry rows for freshly trained models, with an ``error`` column.

    ``trained`` holds ``model_id`` and ``expected_features``. A model in production gets a copy
    of its row with the patch raised, today's date and all scores zero; an unknown one starts
    at the first version. A version that has not three parts gives no version but an error.
    """
    old = current_versions(registry.filter(F.col("status") == PRODUCTION))
    known = F.col("old.model_id").isNotNull()
    version = F.when(known, versions.next_patch(F.col("old.version"))).otherwise(FIRST_VERSION)
    return (
        trained.alias("new")
        .join(old.alias("old"), F.col("new.model_id") == F.col("old.model_id"), "left")
        .select(
            F.col("new.model_id").alias("model_id"),
            F.coalesce("old.artifact_type", F.lit(FIRST_TYPE)).alias("artifact_type"),
            version.alias("version"),
            as_of.cast("date").alias("trained_date"),
            F.lit(0.0).alias("model_drift_score"),
            F.lit(PRODUCTION).alias("status"),
            F.coalesce("old.azure_location", text.model_location(F.col("new.model_id"))).alias(
                "azure_location"
            ),
            reset_scores(F.col("new.expected_features")).alias("expected_features"),
            as_of.cast("timestamp").alias("created_at"),
            F.when(version.isNull(), F.concat(F.lit("bad version "), F.col("old.version"))).alias(
                "error"
            ),
        )
    )


def with_new_versions(registry: DataFrame, added: DataFrame) -> DataFrame:
    """Old rows kept, new ones appended, superseded production rows deprecated."""
    return deprecate_superseded(registry.unionByName(added.select(*registry.columns)))


def deprecate_superseded(registry: DataFrame) -> DataFrame:
    """Of each model only the highest production version stays in production."""
    order = versions.sort_key(F.col("version"))
    newest = (
        registry.filter(F.col("status") == PRODUCTION)
        .groupBy("model_id")
        .agg(F.max(order).alias("newest"))
    )
    older = (F.col("status") == PRODUCTION) & (order < F.col("newest"))
    return (
        registry.join(newest, "model_id", "left")
        .withColumn("status", F.when(older, DEPRECATED).otherwise(F.col("status")))
        .select(*registry.columns)
    )


def id_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Model ids added to or removed from the production set since the last snapshot."""
    sides = before.select("model_id", F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(
        after.select("model_id", F.lit(0).alias("old"), F.lit(1).alias("new"))
    )
    return (
        sides.groupBy("model_id")
        .agg(F.max("old").alias("old"), F.max("new").alias("new"))
        .filter(F.col("old") != F.col("new"))
        .select("model_id", F.when(F.col("new") == 1, "added").otherwise("removed").alias("change"))
    )


def model_features(registry: DataFrame) -> DataFrame:
    """One row per model version and distinct feature name."""
    names = F.array_distinct(F.transform("expected_features", lambda f: f["name"]))
    return registry.select("model_id", "version", F.explode(names).alias("feature_name"))


def model_drift(registry: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per production model its list of feature metrics and whether any of them drifted.

    Models without features are left out; a model whose features have no data keeps an empty
    list and counts as not drifted.
    """
    metric = F.struct(
        "feature_name", "ks_stat", "ks_p_value", "psi", "kl_divergence", "status"
    )
    scores = join_side(metrics.select("feature_name", metric.alias("metric")))
    current = registry.filter(F.col("status") == PRODUCTION)
    return (
        model_features(current)
        .join(scores, "feature_name", "left")
        .groupBy("model_id", "version")
        .agg(
            F.coalesce(
                F.bool_or(F.col("metric.status").isin("WARNING", "CRITICAL")), F.lit(False)
            ).alias("drift_detected"),
            F.array_sort(F.collect_list("metric")).alias("feature_metrics"),
        )
    )


def retrain_models(
    registry: DataFrame, metrics: DataFrame, statuses: tuple[str, ...] = ("CRITICAL",)
) -> DataFrame:
    """Production models that use at least one feature with such a status."""
    drifted = join_side(metrics.filter(F.col("status").isin(*statuses)).select("feature_name"))
    current = registry.filter(F.col("status") == PRODUCTION)
    return (
        model_features(current)
        .join(drifted, "feature_name", "left_semi")
        .select("model_id", "version")
        .distinct()
    )


def write_back_scores(registry: DataFrame, metrics: DataFrame) -> DataFrame:
    """Registry with the PSI of each feature inside ``expected_features``, order unchanged.

    Features without a metric keep their score. The scores of one model form a map no longer
    than its feature list.
    """
    scores = join_side(metrics.select("feature_name", "psi"))
    current = registry.filter(F.col("status") == PRODUCTION)
    maps = (
        model_features(current)
        .join(scores, "feature_name")
        .select("model_id", "version", "feature_name", "psi")
        .distinct()
        .groupBy("model_id", "version")
        .agg(F.map_from_entries(F.collect_list(F.struct("feature_name", "psi"))).alias("scores"))
    )
    updated = F.transform(
        "expected_features",
        lambda f: f.withField(
            "drift_score", F.coalesce(F.col("scores")[f["name"]], f["drift_score"])
        ),
    )
    fresh = F.when(
        (F.col("status") == PRODUCTION) & F.col("scores").isNotNull(), updated
    ).otherwise(F.col("expected_features"))
    return (
        registry.join(maps, ["model_id", "version"], "left")
        .withColumn("expected_features", fresh)
        .select(*registry.columns)
    )


def snapshot(registry: DataFrame) -> DataFrame:
    """Key and JSON value per production model."""
    current = production_models(registry)
    return current.select(
        F.concat(F.lit("model_metadata:"), F.col("model_id")).alias("key"),
        F.to_json(F.struct(*current.columns)).alias("value"),
    )


def artifact_inventory(registry: DataFrame, files: DataFrame) -> DataFrame:
    """Production files under each production model's location, with their store key.

    ``files`` holds ``path``, relative to the artifact root. A location is matched with every
    folder above a file, so the prefix test is an equality join.
    """
    parts = F.split("path", "/")
    above = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda depth: F.concat(F.array_join(F.slice(parts, F.lit(1), depth), "/"), F.lit("/")),
    )
    candidates = files.filter(text.is_production_file(F.col("path"))).select(
        *files.columns, F.explode(above).alias("azure_location")
    )
    current = registry.filter(F.col("status") == PRODUCTION).select("model_id", "azure_location").distinct()
    return current.join(candidates, "azure_location").select(
        "model_id", *files.columns, text.artifact_key(F.col("model_id"), F.col("path")).alias("key")
    )


def models_without_artifact(registry: DataFrame, inventory: DataFrame) -> DataFrame:
    current = registry.filter(F.col("status") == PRODUCTION).select("model_id").distinct()
    return current.join(inventory.select("model_id").distinct(), "model_id", "left_anti")


def artifact_names(inventory: DataFrame, number: Column) -> DataFrame:
    """Archive name of each production file and the name of its replacement."""
    return inventory.select(
        "model_id",
        "path",
        text.archive_file(F.col("path"), number).alias("archive_path"),
        text.production_file(F.col("model_id"), text.file_extension(F.col("path"))).alias(
            "production_path"
        ),
    )
