"""Queries on the model registry, serving and the prediction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import registry, serving
from tidemark.suite import base
from tidemark.suite.base import clock, query, sql_clock, table

REGISTRY = f"WITH {base.REGISTRY_SQL}"
AS_OF = "2024-03-01"


@query(
    "production_models",
    f"""{REGISTRY} SELECT r.model_id, r.artifact_type, r.version, strftime(r.trained_date, '%Y-%m-%d') AS trained_date,
        r.model_drift_score, r.status, r.azure_location,
        '[' || coalesce(string_agg('{{"index":' || f.index || ',"name":"' || f.feature_name || '","type":"' || f.type
            || '","drift_score":' || CAST(r.model_drift_score AS VARCHAR) || '}}', ',' ORDER BY f.index), '') || ']' AS features_json
    FROM registry r LEFT JOIN model_features f
      ON f.model_id = r.model_id AND f.version = r.version AND f.status = r.status
    WHERE r.status = 'production' GROUP BY ALL""",
)
def _(spark, sf_dir):
    return registry.production_models(base.registry(spark, sf_dir))


@query(
    "usable_models",
    f"{REGISTRY} SELECT model_id, version FROM registry WHERE bits & 31 <> 0",
)
def _(spark, sf_dir):
    return registry.usable_models(base.registry(spark, sf_dir)).select("model_id", "version")


@query(
    "missing_models",
    f"""{REGISTRY} SELECT DISTINCT 'm' || c_custkey AS model_id FROM customer
    WHERE 'm' || c_custkey NOT IN (SELECT model_id FROM registry)""",
)
def _(spark, sf_dir):
    required = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("model_id")
    )
    return registry.missing_models(required, base.registry(spark, sf_dir))


@query(
    "latest_version",
    f"""{REGISTRY} SELECT model_id, version, status FROM (
      SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY sort_key DESC) AS place FROM ordered)
    WHERE place = 1""",
)
def _(spark, sf_dir):
    return registry.current_versions(base.registry(spark, sf_dir)).select(
        "model_id", "version", "status"
    )


def _trained(spark, sf_dir):
    """Retrained feature lists: one per customer, so some models are new to the registry."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("model_id"),
        base.features_of(F.col("c_nationkey") + 1, F.lit(0.5)).alias("expected_features"),
    )


_NEXT = f"""next_rows AS (
      SELECT 'm' || c_custkey AS model_id, n.artifact_type AS old_type, n.version AS old_version,
             n.azure_location AS old_location, n.sort_key, c_nationkey + 1 AS bits,
             CASE WHEN n.model_id IS NULL THEN '0.1.0'
                  WHEN len(n.sort_key) = 3 THEN n.sort_key[1] || '.' || n.sort_key[2] || '.' || (n.sort_key[3] + 1)
             END AS version
      FROM customer LEFT JOIN newest n ON n.model_id = 'm' || c_custkey)"""


@query(
    "next_versions",
    f"""{REGISTRY}, {_NEXT} SELECT model_id, version, 'production' AS status, '{AS_OF}' AS trained_date,
        coalesce(old_type, 'pkl') AS artifact_type, coalesce(old_location, 'Model_' || model_id || '/') AS azure_location,
        CASE WHEN version IS NULL THEN 'bad version ' || old_version ELSE '' END AS error,
        CAST(bit_count(CAST(bits & 31 AS INTEGER)) AS INTEGER) AS features, CAST(0 AS DOUBLE) AS score FROM next_rows""",
)
def _(spark, sf_dir):
    rows = registry.retrained_rows(
        base.registry(spark, sf_dir), _trained(spark, sf_dir), F.lit(AS_OF)
    )
    return rows.select(
        "model_id",
        "version",
        "status",
        text.day_text(F.col("trained_date")).alias("trained_date"),
        "artifact_type",
        "azure_location",
        F.coalesce("error", F.lit("")).alias("error"),
        F.size("expected_features").alias("features"),
        F.aggregate("expected_features", F.lit(0.0), lambda a, f: a + f["drift_score"]).alias("score"),
    )


@query(
    "deprecate_versions",
    f"""{REGISTRY}, {_NEXT}, every AS (
      SELECT model_id, version, status, sort_key FROM ordered
      UNION ALL SELECT model_id, version, 'production',
        [coalesce(TRY_CAST(x AS INTEGER), 0) FOR x IN string_split(version, '.')] FROM next_rows WHERE version IS NOT NULL),
    best AS (SELECT model_id, max(sort_key) AS top FROM every WHERE status = 'production' GROUP BY model_id)
    SELECT e.model_id, e.version, CASE WHEN e.status = 'production' AND e.sort_key < b.top THEN 'deprecated'
           ELSE e.status END AS status FROM every e LEFT JOIN best b USING (model_id)""",
)
def _(spark, sf_dir):
    old = base.registry(spark, sf_dir)
    added = registry.retrained_rows(old, _trained(spark, sf_dir), F.lit(AS_OF))
    renewed = registry.with_new_versions(old, added.filter(F.col("error").isNull()))
    return renewed.select("model_id", "version", "status")


@query(
    "registry_delta",
    f"""{REGISTRY}, before AS (SELECT DISTINCT model_id FROM registry WHERE status = 'production' AND bits < 40),
    after AS (SELECT DISTINCT model_id FROM registry WHERE status = 'production' AND bits >= 10)
    SELECT model_id, 'added' AS change FROM after WHERE model_id NOT IN (SELECT model_id FROM before)
    UNION ALL SELECT model_id, 'removed' FROM before WHERE model_id NOT IN (SELECT model_id FROM after)""",
)
def _(spark, sf_dir):
    current = registry.production_models(base.registry(spark, sf_dir))
    return registry.id_changes(
        current.filter(F.col("model_drift_score") < 0.40),
        current.filter(F.col("model_drift_score") >= 0.10),
    )


@query(
    "snapshot_json",
    f"""{REGISTRY} SELECT 'model_metadata:' || model_id AS key, version, strftime(trained_date, '%Y-%m-%d') AS trained_date,
        CAST(bit_count(CAST(bits & 31 AS INTEGER)) AS INTEGER) AS features FROM registry WHERE status = 'production'""",
)
def _(spark, sf_dir):
    published = registry.snapshot(base.registry(spark, sf_dir))
    read = F.from_json("value", "version string, trained_date string, features_json string")
    return published.select("key", read.alias("read")).select(
        "key",
        "read.version",
        "read.trained_date",
        F.size(registry.parsed_features(F.col("read.features_json"))).alias("features"),
    )


def _files(spark, sf_dir):
    """A listing of artifact files: live, archived and nested ones."""
    key = F.col("p_partkey")
    model = F.concat(F.lit("m"), F.floor(key / 4).cast("string"))
    folder = F.concat(F.lit("Model_"), model)
    return table(spark, sf_dir, "part").select(
        F.when(key % 5 == 0, F.concat(folder, F.lit("/"), folder, F.lit("_Production.pkl")))
        .when(key % 5 == 1, F.concat(folder, F.lit("/"), folder, F.lit("_17.pkl")))
        .when(key % 5 == 2, F.concat(folder, F.lit("/meta.v1/"), folder, F.lit("_Production.json")))
        .when(key % 5 == 3, F.concat(F.lit("Other/"), folder, F.lit("_Production.pkl")))
        .otherwise(F.concat(folder, F.lit("/readme")))
        .alias("path")
    )


_FILES = """files AS (
      SELECT p_partkey AS k, 'm' || CAST(floor(p_partkey / 4) AS BIGINT) AS model_id,
             'Model_m' || CAST(floor(p_partkey / 4) AS BIGINT) AS folder FROM part),
    found AS (
      SELECT model_id, CASE k % 5 WHEN 0 THEN folder || '/' || folder || '_Production.pkl'
                       ELSE folder || '/meta.v1/' || folder || '_Production.json' END AS path,
             CASE k % 5 WHEN 0 THEN 'pkl' ELSE 'json' END AS ext,
             CASE k % 5 WHEN 0 THEN folder || '/' || folder ELSE folder || '/meta.v1/' || folder END AS head
      FROM files WHERE k % 5 IN (0, 2)
        AND model_id IN (SELECT model_id FROM registry WHERE status = 'production'))"""


@query(
    "artifact_inventory",
    f"{REGISTRY}, {_FILES} SELECT model_id, path, 'model:' || model_id || ':' || ext AS key FROM found",
)
def _(spark, sf_dir):
    return registry.artifact_inventory(base.registry(spark, sf_dir), _files(spark, sf_dir))


@query(
    "models_without_artifact",
    f"""{REGISTRY}, {_FILES} SELECT DISTINCT model_id FROM registry
    WHERE status = 'production' AND model_id NOT IN (SELECT model_id FROM found WHERE ext = 'pkl')""",
)
def _(spark, sf_dir):
    models = base.registry(spark, sf_dir)
    pickles = _files(spark, sf_dir).filter(F.col("path").endswith(".pkl"))
    inventory = registry.artifact_inventory(models, pickles)
    return registry.models_without_artifact(models, inventory)


@query(
    "artifact_names",
    f"""{REGISTRY}, {_FILES} SELECT model_id, path, head || '_7.' || ext AS archive_path,
        'Model_' || model_id || '/Model_' || model_id || '_Production.' || ext AS production_path FROM found""",
)
def _(spark, sf_dir):
    inventory = registry.artifact_inventory(base.registry(spark, sf_dir), _files(spark, sf_dir))
    return registry.artifact_names(inventory, F.lit(7))


# --- serving -----------------------------------------------------------------------------


def _requests(spark, sf_dir):
    """One request per order, with numbers, decimals, exponents, text and gaps as inputs."""
    key = F.col("o_orderkey")
    raw = (
        F.when(key % 5 == 0, (key % 100).cast("string"))
        .when(key % 5 == 1, F.concat((key % 100).cast("string"), F.lit(".5")))
        .when(key % 5 == 2, F.lit("1e5"))
        .when(key % 5 == 3, F.lit("abc"))
        .otherwise(F.lit(""))
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("request_id"),
        F.concat(F.lit("m"), (key % 50).cast("string")).alias("model_id"),
        F.create_map(
            *[part for _, name, _ in base.MODEL_INPUTS for part in (F.lit(name), raw)]
        ).alias("features"),
    )


_REQUESTS = """requests AS (
      SELECT o_orderkey AS request_id, 'm' || (o_orderkey % 50) AS model_id, o_orderkey % 5 AS shape,
             CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey % 100 AS VARCHAR)
               WHEN 1 THEN (o_orderkey % 100) || '.5' WHEN 2 THEN '1e5' WHEN 3 THEN 'abc' ELSE '' END AS raw
      FROM orders)"""


@query(
    "typed_inputs",
    f"""{REGISTRY}, {_REQUESTS}
    SELECT request_id, r.model_id, CAST(f.index AS INTEGER) AS index, f.feature_name,
      CASE WHEN lower(f.type) IN ('int', 'integer') THEN CASE WHEN shape = 0 THEN CAST(raw AS DOUBLE) ELSE 0 END END AS whole_value,
      CASE WHEN lower(f.type) IN ('float', 'double') THEN CASE WHEN shape <= 2 THEN CAST(raw AS DOUBLE) ELSE 0 END END AS real_value,
      CASE WHEN lower(f.type) = 'text' THEN raw ELSE '' END AS text_value
    FROM requests r JOIN model_features f ON f.model_id = r.model_id
    JOIN newest n ON n.model_id = f.model_id AND n.version = f.version AND f.status = 'production'""",
)
def _(spark, sf_dir):
    models = base.registry(spark, sf_dir).filter(F.col("status") == "production")
    read = serving.typed_inputs(_requests(spark, sf_dir), registry.current_versions(models))
    return read.withColumns(
        {
            "whole_value": F.col("whole_value").cast("double"),
            "text_value": F.coalesce("text_value", F.lit("")),
        }
    )


@query(
    "guessed_inputs",
    f"""WITH {_REQUESTS} SELECT request_id, CASE WHEN shape = 0 THEN 'whole' WHEN shape IN (1, 2) THEN 'real' ELSE 'text' END AS kind,
        CASE WHEN shape <= 2 THEN CAST(raw AS DOUBLE) END AS number, count(*) AS inputs
    FROM requests CROSS JOIN range(5) GROUP BY ALL""",
)
def _(spark, sf_dir):
    guessed = serving.guessed_inputs(_requests(spark, sf_dir))
    return guessed.groupBy("request_id", "kind", "number").agg(F.count(F.lit(1)).alias("inputs"))


@query(
    "log_predictions",
    f"""WITH {base.PREDICTION_SQL} SELECT model_id, model_version, model_inputs, printf('%.6f', prediction) AS model_result,
        model_error, {sql_clock('predicted_at')} AS event_datetime FROM predictions""",
)
def _(spark, sf_dir):
    rows = serving.log_rows(base.predictions(spark, sf_dir), F.col("predicted_at"))
    return rows.withColumn("event_datetime", clock("event_datetime"))


@query(
    "error_rate",
    f"""WITH {base.PREDICTION_SQL} SELECT model_id, model_version, count(*) AS predictions,
        count(*) FILTER (WHERE model_error <> '') AS failures,
        round(avg(CASE WHEN model_error <> '' THEN 1 ELSE 0 END), 9) AS error_rate
    FROM predictions GROUP BY model_id, model_version""",
)
def _(spark, sf_dir):
    rows = serving.log_rows(base.predictions(spark, sf_dir), F.col("predicted_at"))
    return serving.error_rates(rows).withColumn("error_rate", F.round("error_rate", 9))


@query(
    "canary_split",
    """SELECT 'user_' || user_id AS entity_id, CASE WHEN
        CAST(('0x' || substr(md5('user_' || user_id), 1, 8)) AS BIGINT) % 100 < 5 THEN 'canary' ELSE 'stable' END AS arm,
        count(*) AS events FROM events GROUP BY user_id""",
)
def _(spark, sf_dir):
    split = serving.canary_split(base.feature_log(spark, sf_dir), 5)
    return split.groupBy("entity_id", "arm").agg(F.count(F.lit(1)).alias("events"))


_LABELED = f"""WITH {base.PREDICTION_SQL}, {base.LABEL_SQL},
    labeled AS (
      SELECT p.*, CASE WHEN p.prediction > 30 THEN 1 ELSE 0 END AS predicted, l.label, l.labeled_at
      FROM predictions p LEFT JOIN late_labels l ON l.event_id = p.event_id
        AND l.labeled_at BETWEEN p.predicted_at AND p.predicted_at + INTERVAL 3 DAYS)"""


@query(
    "prediction_labels",
    f"""{_LABELED} SELECT event_id, CAST(label AS DOUBLE) AS label, {sql_clock('labeled_at')} AS labeled_at FROM labeled""",
)
def _(spark, sf_dir):
    joined = serving.with_labels(
        base.predictions(spark, sf_dir),
        base.late_labels(spark, sf_dir),
        "event_id",
        F.make_dt_interval(F.lit(3)),
    )
    return joined.select(
        "event_id", F.col("label").cast("double").alias("label"), clock("labeled_at").alias("labeled_at")
    )


@query(
    "label_metrics",
    f"""{_LABELED}, counts AS (
      SELECT model_id, count(*) AS labeled, count(*) FILTER (WHERE predicted = 1 AND label = 1) AS tp,
             count(*) FILTER (WHERE predicted = 1 AND label = 0) AS fp,
             count(*) FILTER (WHERE predicted = 0 AND label = 1) AS fn,
             count(*) FILTER (WHERE predicted = 0 AND label = 0) AS tn
      FROM labeled WHERE label IS NOT NULL GROUP BY model_id)
    SELECT *, round((tp + tn) / labeled, 9) AS accuracy, round(tp / (tp + fp), 9) AS "precision",
           round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM counts""",
)
def _(spark, sf_dir):
    joined = serving.with_labels(
        base.predictions(spark, sf_dir),
        base.late_labels(spark, sf_dir),
        "event_id",
        F.make_dt_interval(F.lit(3)),
    ).withColumn("predicted", (F.col("prediction") > 30).cast("int"))
    found = serving.label_metrics(joined)
    shares = ("accuracy", "precision", "recall", "f1")
    return found.select(
        "model_id", "labeled", "tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in shares]
    )
