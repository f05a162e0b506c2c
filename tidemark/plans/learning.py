"""Training, evaluation, promotion and batch inference with MLlib."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coercion import guessed_number
from tidemark.functions.traffic import traffic_bucket

# Prediction and message forms of a request that cannot be served.
FAILED = -1.0


@dataclass(frozen=True)
class ModelSpec:
    """What a training job fits: kind, inputs in order, label."""

    model_id: str
    kind: str
    features: tuple[str, ...]
    label: str
    classes: int = 0


def output_descriptor(spec: ModelSpec) -> dict:
    """Type of the output and whether it is a class."""
    classification = spec.kind != "linear"
    return {
        "type": "Integer" if classification else "Float",
        "is_classification": classification,
        "classes": list(range(spec.classes)) if classification else [],
    }


def feature_list(spec: ModelSpec) -> list[dict]:
    """Registry form of the inputs."""
    return [
        {"index": i, "name": name, "type": "float", "drift_score": 0.0}
        for i, name in enumerate(spec.features)
    ]


def fit(spec: ModelSpec, rows: DataFrame) -> PipelineModel:
    """Fit one model; data stays distributed.

    The logistic penalty equals a squared penalty of weight 1 on the summed loss, that is 1/n
    on the mean loss, on unscaled inputs.
    """
    inputs = VectorAssembler(inputCols=list(spec.features), outputCol="inputs", handleInvalid="skip")
    shared = {"featuresCol": "inputs", "labelCol": spec.label, "predictionCol": "prediction"}
    if spec.kind == "linear":
        learner = LinearRegression(solver="normal", regParam=0.0, **shared)
    elif spec.kind == "logistic":
        penalty = 1.0 / max(inputs.transform(rows).count(), 1)
        learner = LogisticRegression(regParam=penalty, standardization=False, **shared)
    elif spec.kind == "tree":
        learner = DecisionTreeClassifier(maxDepth=5, seed=1, **shared)
    else:
        raise ValueError(f"unknown kind of model: {spec.kind}")
    return Pipeline(stages=[inputs, learner]).fit(rows)


def hash_split(rows: DataFrame, key: Column, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same split on every run and layout."""
    bucket = traffic_bucket(key)
    return rows.filter(bucket < train_percent), rows.filter(bucket >= train_percent)


def evaluate(spec: ModelSpec, scored: DataFrame) -> DataFrame:
    """One row: accuracy of a classifier, or R2 of a regression, over rows with predictions."""
    label, said = F.col(spec.label).cast("double"), F.col("prediction")
    if spec.kind == "linear":
        miss = (label - said) * (label - said)
        score = 1 - F.sum(miss) / (F.var_pop(label) * F.count(label))
    else:
        score = F.avg((label == said).cast("double"))
    return scored.agg(
        F.lit(spec.model_id).alias("model_id"), F.count(F.lit(1)).alias("tested"), score.alias("score")
    )


def train_job(
    spec: ModelSpec, rows: DataFrame, key: Column, train_percent: int = 80
) -> tuple[PipelineModel, DataFrame]:
    """Split, fit, evaluate: the model and its one-row score."""
    train, test = hash_split(rows, key, train_percent)
    model = fit(spec, train)
    return model, evaluate(spec, model.transform(test))


def promote(champion: DataFrame, challenger: DataFrame) -> DataFrame:
    """Per model id whether the challenger takes over: only with a strictly better score."""
    better = F.col("new.score") > F.col("old.score")
    return (
        challenger.alias("new")
        .join(champion.alias("old"), F.col("new.model_id") == F.col("old.model_id"), "left")
        .select(
            F.col("new.model_id").alias("model_id"),
            F.col("old.score").alias("old_score"),
            F.col("new.score").alias("new_score"),
            F.coalesce(better, F.lit(True)).alias("promoted"),
        )
    )


class Served(NamedTuple):
    """A fitted model in numbers: what a task needs to predict, whatever it was fitted with.

    Linear models have ``weights`` (a row per class, one row for a regression or two classes) and ``intercepts``; trees
    have ``nodes``, each (input, threshold, node if at or below it, node otherwise, prediction), leaves with input -1.
    """

    kind: str
    features: tuple[str, ...]
    weights: np.ndarray
    intercepts: np.ndarray
    nodes: np.ndarray


def served(spec: ModelSpec, model: PipelineModel) -> Served:
    """The numbers of a fitted model."""
    fitted = model.stages[-1]
    none = np.zeros((0, 5))
    if spec.kind == "linear":
        return Served(spec.kind, spec.features, fitted.coefficients.toArray()[None, :], np.array([fitted.intercept]), none)
    if spec.kind == "logistic":
        return Served(spec.kind, spec.features, fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray(), none)
    return Served(spec.kind, spec.features, none, none, tree_nodes(fitted.toDebugString))


def tree_nodes(described: str) -> np.ndarray:
    """Nodes of a tree from its description: a line per condition, its opposite, or prediction, in depth-first order."""
    nodes: list[list[float]] = []
    open_nodes: list[int] = []
    for line in described.splitlines():
        words = line.replace("(", " ").replace(")", " ").split()
        if not words or words[0] not in ("If", "Else", "Predict:"):
            continue
        if words[0] == "Else":
            nodes[open_nodes.pop()][3] = len(nodes)
        elif words[0] == "If":
            open_nodes.append(len(nodes))
            nodes.append([float(words[2]), float(words[4]), len(nodes) + 1, -1, 0.0])
        else:
            nodes.append([-1.0, 0.0, -1, -1, float(words[1])])
    return np.array(nodes)


def predicted(model: Served, inputs: np.ndarray) -> np.ndarray:
    """Predictions for rows of inputs in the order of the model's features."""
    if model.kind == "tree":
        at = np.zeros(len(inputs), np.int64)
        while True:
            feature, threshold, low, high, said = model.nodes[at].T
            inner = feature >= 0
            if not inner.any():
                return said
            value = inputs[np.arange(len(inputs)), np.maximum(feature, 0).astype(int)]
            at = np.where(inner, np.where(value <= threshold, low, high), at).astype(np.int64)
    margins = inputs @ model.weights.T + model.intercepts
    if model.kind == "linear":
        return margins[:, 0]
    return (margins[:, 0] > 0).astype(float) if margins.shape[1] == 1 else margins.argmax(1).astype(float)


def batch_inference(requests: DataFrame, models: dict[str, tuple[ModelSpec, Model]]) -> DataFrame:
    """Prediction and error per request; a request never fails the batch.

    ``requests``: ``request_id``, ``model_id``, ``features`` (map of texts). One pass for any number of models:
    inputs are read as numbers in the JVM, and in each Arrow batch the requests of one model are predicted together.
    A model is sent as a few numbers (:class:`Served`). Unknown models and unreadable inputs give -1 and a message.
    """
    store = {model_id: served(spec, model) for model_id, (spec, model) in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("model_id")
            said = np.full(batch.num_rows, FAILED)
            errors = np.full(batch.num_rows, "", dtype=object)
            for model_id in pc.unique(ids).to_pylist():
                own = np.flatnonzero((pc.is_null(ids) if model_id is None else pc.fill_null(pc.equal(ids, model_id), False)).to_numpy(False))
                model = store.get(model_id)
                if model is None:
                    errors[own] = f"Model {'?' if model_id is None else model_id} not found"
                    continue
                maps = batch.column("numbers").take(pa.array(own))
                columns = [pc.map_lookup(maps, pa.scalar(name), "first").to_numpy(False) for name in model.features]
                inputs = np.array(columns, dtype=float).reshape(len(columns), len(own)).T
                good = ~np.isnan(inputs).any(1)
                said[own[good]] = predicted(model, inputs[good])
                errors[own[~good]] = "Prediction failed: input missing or no number"
            yield pa.RecordBatch.from_arrays(
                [batch.column("request_id"), ids, pa.array(said), pa.array(errors, pa.string())],
                ["request_id", "model_id", "prediction", "error"],
            )

    numbers = F.transform_values("features", lambda _, text: guessed_number(text))
    read = requests.select("request_id", F.col("model_id").cast("string"), numbers.alias("numbers"))
    kind = requests.schema["request_id"].dataType.simpleString()
    return read.mapInArrow(run, f"request_id {kind}, model_id string, prediction double, error string")
