"""Publishing what training and drift jobs find: models with their registry rows, and metrics.

A job has an id, and everything it writes is known by it, so a repeat of a job, whole or from where it
broke off, leaves what one run leaves. An artifact is written first and named by a registry row
afterwards: a reader never meets a row without its model.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import versions
from tidemark.operators.registry import FIRST_VERSION, PRODUCTION
from tidemark.plans.learning import ModelSpec, feature_list
from tidemark.sinks.keyed import KeyedStore

CANDIDATE, ARCHIVED = "candidate", "archived"
MODELS = (
    "job_id string, model_id string, kind string, version string, location string, score double, status string, "
    "expected_features array<struct<index:int,name:string,type:string,drift_score:double>>, change long"
)
METRICS = "model_id string, feature_name string, slice_end timestamp, metric string, value double, job_id string"


def newest_change(rows: DataFrame) -> DataFrame:
    """The last state of each job's model."""
    others = [name for name in rows.columns if name != "job_id"]
    last = rows.groupBy("job_id").agg(F.max_by(F.struct(*others), "change").alias("last"))
    return last.select("job_id", "last.*")


def model_store(spark: SparkSession, path: str) -> KeyedStore:
    """Registry rows, one per job. One writer at a time."""
    return KeyedStore(spark, path, MODELS, ("job_id",), newest_change, buckets=1)


def publish(model: PipelineModel, spec: ModelSpec, score: float, job_id: str, store: KeyedStore, root: str) -> Row:
    """Write the model, then its registry row as a candidate; a job that was published before keeps its row.

    The version is the model's highest published one with its patch raised, 0.1.0 at first.
    """
    known = store.read().filter(F.col("model_id") == spec.model_id)
    mine = known.filter(F.col("job_id") == job_id).first()
    if mine is not None:
        return mine
    location = f"{root.rstrip('/')}/{spec.model_id}/{job_id}"
    model.write().overwrite().save(location)
    # A model's rows are few.
    newest = known.orderBy(versions.sort_key(F.col("version")).desc()).select(versions.next_patch(F.col("version")).alias("next")).first()
    features = [tuple(feature.values()) for feature in feature_list(spec)]
    row = (job_id, spec.model_id, spec.kind, FIRST_VERSION if newest is None else newest["next"], location, float(score), CANDIDATE, features, store.pointer().version)
    store.amend(store.spark.createDataFrame([row], MODELS))
    return store.read().filter(F.col("job_id") == job_id).first()


def promote_job(job_id: str, store: KeyedStore) -> bool:
    """Let a candidate take over from the model in production if its score is strictly better, or if there is none.

    The one that loses is archived; both rows change in one version. A repeat changes nothing.
    """
    rows = store.read()
    mine = rows.filter(F.col("job_id") == job_id).first()
    if mine is None:
        raise ValueError(f"job {job_id} was not published")
    if mine["status"] != CANDIDATE:
        return mine["status"] == PRODUCTION
    own = rows.filter(F.col("model_id") == mine["model_id"])
    old = own.filter(F.col("status") == PRODUCTION).first()
    better = old is None or mine["score"] > old["score"]
    status = F.when(F.col("job_id") == job_id, PRODUCTION if better else ARCHIVED).otherwise(ARCHIVED)
    touched = [job_id] + ([old["job_id"]] if better and old is not None else [])
    changed = own.filter(F.col("job_id").isin(touched)).withColumns({"status": status, "change": F.lit(store.pointer().version)})
    store.amend(changed)
    return better


def in_production(store: KeyedStore, model_id: str) -> tuple[Row, PipelineModel]:
    """The registry row and the model that serve a model id."""
    row = store.read().filter((F.col("model_id") == model_id) & (F.col("status") == PRODUCTION)).first()
    if row is None:
        raise LookupError(f"no model {model_id} in production")
    return row, PipelineModel.load(row["location"])


def first_written(rows: DataFrame) -> DataFrame:
    """One row per metric of a slice: equal for all runs of a job, the first job's by id otherwise."""
    keys = ["model_id", "feature_name", "slice_end", "metric"]
    return rows.groupBy(*keys).agg(F.min_by(F.struct("value", "job_id"), F.struct("job_id", "value")).alias("kept")).select(*keys, "kept.*")


def metric_log(spark: SparkSession, path: str) -> KeyedStore:
    """Drift metrics of models over time, one row per model, feature, end of the slice and metric."""
    return KeyedStore(spark, path, METRICS, ("model_id", "feature_name", "slice_end", "metric"), first_written)


def record_metrics(log: KeyedStore, metrics: DataFrame, model_id: str, slice_end, job_id: str) -> None:
    """Append metrics (``feature_name``, ``metric``, ``value``) of a model and slice; a repeated run adds nothing."""
    rows = metrics.select(
        F.lit(model_id).alias("model_id"), "feature_name", F.lit(slice_end).cast("timestamp").alias("slice_end"), "metric", "value", F.lit(job_id).alias("job_id")
    )
    log.amend(rows)
