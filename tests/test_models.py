from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import registry, serving
from tidemark.plans import learning, publication
from tidemark.runtime import scratch_path
from tidemark.schemas import MODEL_METADATA
from tidemark.sinks import pointer
from tidemark.sources import artifacts

NOW = datetime(2024, 1, 1)


def model(model_id, version, status="production", names=("f", "g")):
    listed = [(i, n, "float", 0.5) for i, n in enumerate(names)]
    return (model_id, "pkl", version, date(2024, 1, 1), 0.5, status, f"Model_{model_id}/", listed, NOW)


@pytest.fixture(scope="module")
def models(spark):
    return spark.createDataFrame(
        [
            model("rent", "0.1.9", "deprecated"),
            model("rent", "0.1.10"),
            model("refund", "1.0", names=("g", "g", "h")),
            model("Empty", "0.1.0", names=()),
            model("Lab", "0.1.0", "staging"),
        ],
        MODEL_METADATA,
    )


@pytest.fixture(scope="module")
def metrics(spark):
    return spark.createDataFrame(
        [("f", 0.0, 1.0, 0.01, 0.0, "PASS"), ("g", 0.5, 0.0, 0.9, 0.2, "CRITICAL")],
        "feature_name string, ks_stat double, ks_p_value double, psi double, kl_divergence double, status string",
    )


def test_versions_compare_as_numbers(models):
    got = {r.model_id: r.version for r in registry.current_versions(models).collect()}
    assert got["rent"] == "0.1.10"


def test_missing_models(spark, models):
    required = spark.createDataFrame([("rent",), ("parcel",)], "model_id string")
    assert [r.model_id for r in registry.missing_models(required, models).collect()] == ["parcel"]


def test_retrained_rows_and_deprecation(spark, models):
    trained = models.filter("model_id in ('rent', 'refund') and status = 'production'").select(
        "model_id", "expected_features"
    ).unionByName(
        models.filter("model_id = 'Lab'").select(F.lit("Brand_New").alias("model_id"), "expected_features")
    )
    rows = {r.model_id: r for r in registry.retrained_rows(models, trained, F.lit("2024-05-01")).collect()}
    assert rows["rent"].version == "0.1.11" and rows["rent"].error is None
    assert rows["rent"].trained_date == date(2024, 5, 1)
    assert [f.drift_score for f in rows["rent"].expected_features] == [0.0, 0.0]
    assert rows["Brand_New"].version == "0.1.0" and rows["Brand_New"].azure_location == "Model_Brand_New/"
    assert rows["refund"].version is None and rows["refund"].error == "bad version 1.0"
    added = registry.retrained_rows(models, trained, F.lit("2024-05-01")).filter("error is null")
    after = {(r.model_id, r.version): r.status for r in registry.with_new_versions(models, added).collect()}
    assert after["rent", "0.1.10"] == "deprecated" and after["rent", "0.1.11"] == "production"
    assert after["Lab", "0.1.0"] == "staging" and len(after) == 7


def test_roll_up_lists_each_feature_once(models, metrics):
    got = {r.model_id: r for r in registry.model_drift(models, metrics).collect()}
    assert set(got) == {"rent", "refund"}
    assert [m.feature_name for m in got["rent"].feature_metrics] == ["f", "g"]
    assert [m.feature_name for m in got["refund"].feature_metrics] == ["g"]
    assert got["rent"].drift_detected and got["refund"].drift_detected
    calm = registry.model_drift(models, metrics.filter("feature_name = 'nothing'")).collect()
    assert all(not r.drift_detected and r.feature_metrics == [] for r in calm) and len(calm) == 2


def test_retrain_selection(models, metrics):
    got = {r.model_id for r in registry.retrain_models(models, metrics).collect()}
    assert got == {"rent", "refund"}
    assert registry.retrain_models(models, metrics, ("WARNING",)).count() == 0


def test_scores_are_written_back_in_place(models, metrics):
    got = {(r.model_id, r.version): r for r in registry.write_back_scores(models, metrics).collect()}
    fresh = got["rent", "0.1.10"].expected_features
    assert [(f["index"], f.name, f.drift_score) for f in fresh] == [(0, "f", 0.01), (1, "g", 0.9)]
    assert [f.drift_score for f in got["refund", "1.0"].expected_features] == [0.9, 0.9, 0.5]
    assert [f.drift_score for f in got["rent", "0.1.9"].expected_features] == [0.5, 0.5]
    assert len(got) == 5


def test_id_changes(spark):
    old = spark.createDataFrame([("a",), ("a",), ("b",)], "model_id string")
    new = spark.createDataFrame([("b",), ("c",)], "model_id string")
    got = {r.model_id: r.change for r in registry.id_changes(old, new).collect()}
    assert got == {"a": "removed", "c": "added"}


def test_unreadable_feature_json_gives_null(spark):
    row = spark.range(1).select(
        registry.parsed_features(F.lit('[{"index":1,"name":"a"}]')).alias("ok"),
        registry.parsed_features(F.lit("[{")).alias("bad"),
    ).first()
    assert row.ok[0].name == "a" and row.bad is None


def test_artifacts_from_files(spark, models, tmp_path):
    for name in (
        "Model_rent/Model_rent_Production.pkl",
        "Model_rent/Model_rent_12.pkl",
        "Model_rent/deep/x_Production.json",
        "Model_rent_2/Model_rent_2_Production.pkl",
        "Model_Lab/Model_Lab_Production.pkl",
    ):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(name.encode())
    found = artifacts.production_artifacts(spark, str(tmp_path), models)
    got = {r.key: bytes(r.content).decode() for r in found.collect()}
    assert set(got) == {"model:rent:pkl", "model:rent:json"}
    assert got["model:rent:pkl"].endswith("_Production.pkl")
    lost = {r.model_id for r in registry.models_without_artifact(models, found).collect()}
    assert lost == {"refund", "Empty"}


def test_label_metrics_and_lag(spark):
    said = spark.createDataFrame(
        [(i, "m", p, NOW) for i, p in enumerate([1, 1, 0, 0, 1])],
        "event_id int, model_id string, predicted int, predicted_at timestamp",
    )
    was = spark.createDataFrame(
        [(i, v, NOW + timedelta(days=d)) for i, v, d in [(0, 1, 1), (1, 0, 1), (2, 1, 2), (3, 0, 0), (4, 1, 9)]],
        "event_id int, label int, labeled_at timestamp",
    )
    joined = serving.with_labels(said, was, "event_id", F.expr("INTERVAL 3 DAYS"))
    assert joined.filter("label is null").count() == 1
    row = serving.label_metrics(joined).first()
    assert (row.labeled, row.tp, row.fp, row.fn, row.tn) == (4, 1, 1, 1, 1)
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.5, 0.5, 0.5)


# --- learning ------------------------------------------------------------------------------

RENT = learning.ModelSpec("rent", "linear", ("size", "rooms"), "price")
REFUND = learning.ModelSpec("refund", "logistic", ("score", "income"), "approved", 2)
PARCEL = learning.ModelSpec("parcel", "tree", ("temperature", "sweetness"), "drink", 3)


@pytest.fixture(scope="module")
def rent_rows(spark):
    # price = 12 * size + 90 * rooms + 40, on a small grid
    rows = [(size, rooms, 12 * size + 90 * rooms + 40) for size in (20, 35, 50, 80) for rooms in (1, 2, 4)]
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "size double, rooms double, price double")


def test_linear_regression(rent_rows):
    fitted = learning.fit(RENT, rent_rows).stages[-1]
    assert fitted.coefficients.toArray() == pytest.approx([12, 90], abs=1e-6)
    assert fitted.intercept == pytest.approx(40, abs=1e-6)


def test_classifiers_learn_their_rows(spark):
    # approved from 50 on, whatever the income
    loans = [(score, income, int(score >= 50)) for score in (10, 30, 60, 90) for income in (1, 5)]
    frame = spark.createDataFrame([tuple(map(float, r)) for r in loans], "score double, income double, approved double")
    assert learning.evaluate(REFUND, learning.fit(REFUND, frame).transform(frame)).first().score == 1.0
    # two cuts of the first input make three classes
    cups = [(heat, heat % 7, (heat >= 30) + (heat >= 60)) for heat in range(0, 90, 6)]
    frame = spark.createDataFrame([tuple(map(float, r)) for r in cups], "temperature double, sweetness double, drink double")
    assert learning.evaluate(PARCEL, learning.fit(PARCEL, frame).transform(frame)).first().score == 1.0


def test_descriptors():
    assert learning.output_descriptor(RENT) == {"type": "Float", "is_classification": False, "classes": []}
    assert learning.output_descriptor(PARCEL)["classes"] == [0, 1, 2]
    assert [f["name"] for f in learning.feature_list(REFUND)] == ["score", "income"]


def test_inference_never_fails_the_batch(spark, rent_rows):
    fitted = learning.fit(RENT, rent_rows)
    requests = spark.createDataFrame(
        [
            (1, "rent", {"size": "1000", "rooms": "2"}),
            (2, "rent", {"size": "big", "rooms": "2"}),
            (3, "rent", {"size": "1000"}),
            (4, "Other", {}),
            (5, None, {}),
        ],
        "request_id int, model_id string, features map<string,string>",
    )
    got = {r.request_id: r for r in learning.batch_inference(requests, {"rent": (RENT, fitted)}).collect()}
    assert got[1].prediction == pytest.approx(12 * 1000 + 90 * 2 + 40, rel=1e-9) and got[1].error == ""
    assert all(got[i].prediction == -1.0 and got[i].error for i in (2, 3, 4, 5)) and len(got) == 5


def test_numbers_of_a_model_predict_like_the_model(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(0, 2, (400, 3)).round(2)
    rows = [(*map(float, p), float(p @ [1, -2, 0.5] + 3), float(p[0] > p[1]), float((p[0] > 0) + (p[2] > 1))) for p in points]
    frame = spark.createDataFrame(rows, "x double, y double, z double, amount double, flag double, class double")
    names = ("x", "y", "z")
    specs = [
        learning.ModelSpec("amount", "linear", names, "amount"),
        learning.ModelSpec("flag", "logistic", names[:2], "flag", 2),
        learning.ModelSpec("many", "logistic", names, "class", 3),
        learning.ModelSpec("tree", "tree", names, "class", 3),
        learning.ModelSpec("stump", "tree", ("x",), "constant", 1),
    ]
    frame = frame.withColumn("constant", F.lit(0.0))
    models = {spec.model_id: (spec, learning.fit(spec, frame)) for spec in specs}
    features = F.create_map(*[x for name in names for x in (F.lit(name), F.col(name).cast("string"))])
    numbered = frame.withColumn("n", F.monotonically_increasing_id())
    asked = numbered.select("n", "x", features.alias("features"), F.explode(F.array(*map(F.lit, [*models, "none"]))).alias("model_id"))
    requests = asked.select(F.concat_ws("/", "model_id", F.col("n").cast("string")).alias("request_id"), "model_id", "features")
    scored = learning.batch_inference(requests, models)
    assert scored._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    got = {r.request_id: (r.prediction, r.error) for r in scored.collect()}
    for name, (_, model) in models.items():
        for row in model.transform(numbered).select("n", "prediction").collect():
            assert got[f"{name}/{row.n}"] == (pytest.approx(row.prediction, rel=1e-9), "")
    assert sum(error == "Model none not found" for _, error in got.values()) == 400


def test_published_models_are_read_back(spark, rent_rows, monkeypatch):
    store, root = publication.model_store(spark, scratch_path(spark, "registry")), scratch_path(spark, "models")
    model = learning.fit(RENT, rent_rows)
    with pytest.raises(LookupError):
        publication.in_production(store, "rent")

    def fail(self, row):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(pointer.Pointer, "publish", fail)
        with pytest.raises(OSError):
            publication.publish(model, RENT, 0.9, "a", store, root)
    assert store.read().count() == 0
    first = publication.publish(model, RENT, 0.9, "a", store, root)
    assert (first.version, first.status) == ("0.1.0", "candidate") and first == publication.publish(model, RENT, 0.1, "a", store, root)
    assert publication.promote_job("a", store) and publication.promote_job("a", store)
    publication.publish(model, RENT, 0.9, "b", store, root)
    assert not publication.promote_job("b", store) and not publication.promote_job("b", store)
    publication.publish(model, RENT, 0.95, "c", store, root)
    assert publication.promote_job("c", store)
    rows = {r.job_id: (r.version, r.status) for r in store.read().collect()}
    assert rows == {"a": ("0.1.0", "archived"), "b": ("0.1.1", "archived"), "c": ("0.1.2", "production")}
    row, read = publication.in_production(store, "rent")
    assert row.job_id == "c" and read.transform(rent_rows).filter("abs(prediction - price) > 1e-6").count() == 0
    with pytest.raises(ValueError):
        publication.promote_job("never", store)


def test_metrics_are_logged_once(spark):
    log = publication.metric_log(spark, scratch_path(spark, "metrics"))
    rows = spark.createDataFrame([("f", "psi", 0.1), ("f", "ks", 0.2), ("g", "psi", None)], "feature_name string, metric string, value double")
    for _ in range(2):
        publication.record_metrics(log, rows, "m", "2024-01-01", "job")
    publication.record_metrics(log, rows, "m", "2024-01-02", "job")
    publication.record_metrics(log, rows, "other", "2024-01-01", "job")
    got = log.read()
    assert got.count() == 9 and got.filter("model_id = 'm'").select("slice_end").distinct().count() == 2


def test_promotion_needs_a_better_score(spark):
    schema = "model_id string, tested bigint, score double"
    old = spark.createDataFrame([("a", 1, 0.8), ("b", 1, 0.8)], schema)
    new = spark.createDataFrame([("a", 1, 0.9), ("b", 1, 0.8), ("c", 1, 0.1)], schema)
    got = {r.model_id: r.promoted for r in learning.promote(old, new).collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_split_is_stable(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    train, test = learning.hash_split(rows, F.col("key"))
    again, _ = learning.hash_split(rows.repartition(7), F.col("key"))
    assert train.count() + test.count() == 1000 and 700 < train.count() < 900
    assert train.exceptAll(again).isEmpty()
