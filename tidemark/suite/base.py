"""Registration of queries, and the inputs they derive from the given tables.

Each input exists twice: as a DataFrame and as a SQL fragment that gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clock(moment: Column | str) -> Column:
    """Timestamps leave a query as text, the same in every engine and time zone."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_clock(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%f')"


# --- feature log -------------------------------------------------------------------------


def feature_log(spark: SparkSession, sf_dir: str, delayed: bool = False) -> DataFrame:
    """Events as log rows; ``delayed`` makes every row known 0 to 2 hours after it happened."""
    moment = F.col("ts").cast("timestamp")
    known = moment + F.make_dt_interval(hours=F.col("event_id") % 3) if delayed else moment
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("entity_id"),
        F.col("event_type").alias("feature_name"),
        "value",
        moment.alias("event_timestamp"),
        known.alias("created_at"),
    )


def log_sql(delayed: bool = False) -> str:
    known = "ts + to_hours(CAST(event_id % 3 AS INTEGER))" if delayed else "ts"
    return f"""log AS (
      SELECT event_id, 'user_' || user_id AS entity_id, event_type AS feature_name, value,
             ts AS event_timestamp, {known} AS created_at
      FROM events)"""


def dirty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with values as text, some missing and some that are no number."""
    n = F.col("event_id")
    return feature_log(spark, sf_dir).withColumn(
        "value",
        F.when(n % 13 == 0, F.lit(None))
        .when(n % 11 == 0, F.lit("abc"))
        .when(n % 17 == 0, F.lit("NaN"))
        .otherwise(F.col("value").cast("string")),
    )


DIRTY_SQL = (
    log_sql()
    + """,
    dirty AS (SELECT *, event_id % 13 = 0 AS missing,
        CASE WHEN event_id % 13 = 0 OR event_id % 11 = 0 OR event_id % 17 = 0 THEN NULL
             ELSE value END AS number FROM log)"""
)


# --- messages ----------------------------------------------------------------------------


def event_messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages, some of them broken in the ways the parser must catch."""
    n, stamp = F.col("event_id"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    moment = F.date_format(F.col("ts"), stamp)
    entity = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    fine = F.to_json(
        F.struct(
            entity.alias("entity_id"),
            F.col("event_type").alias("feature_name"),
            F.col("value").alias("value"),
            F.when(n % 89 == 0, F.lit("yesterday")).otherwise(moment).alias("validated_at"),
            moment.alias("created_at"),
        )
    )
    wrong_type = F.concat(F.lit('{"entity_id":"'), entity, F.lit('","value":"abc"}'))
    body = (
        F.when(n % 97 == 0, F.concat(F.lit('{"entity_id": "'), entity))
        .when(n % 83 == 0, wrong_type)
        .otherwise(fine)
    )
    return events.select("event_id", body.alias("value"))


MESSAGE_SQL = """messages AS (
      SELECT event_id, 'user_' || user_id AS entity_id, event_type AS feature_name, value, ts,
             CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN 'not a JSON event'
                  WHEN event_id % 89 = 0 THEN 'bad event time' END AS error
      FROM events)"""


# --- registry ----------------------------------------------------------------------------

# The features a registered model may use, with their declared types.
MODEL_INPUTS = [
    (0, "click", "int"),
    (1, "error", "float"),
    (2, "purchase", "double"),
    (3, "signup", "Integer"),
    (4, "view", "text"),
]


def features_of(bits: Column, score: Column) -> Column:
    """Feature list with the inputs whose bit is set."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    F.floor(bits / F.lit(2**index)) % 2 == 1,
                    F.struct(
                        F.lit(index).alias("index"),
                        F.lit(name).alias("name"),
                        F.lit(kind).alias("type"),
                        score.alias("drift_score"),
                    ),
                )
                for index, name, kind in MODEL_INPUTS
            ]
        )
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of four versions per model, derived from the parts."""
    key, size = F.col("p_partkey"), F.col("p_size")
    model_id = F.concat(F.lit("m"), F.floor(key / 4).cast("string"))
    version = F.when(key % 101 == 0, F.lit("1.0")).otherwise(
        F.concat(
            F.lit("0."), (size % 3).cast("string"), F.lit("."), (8 + key % 4).cast("string")
        )
    )
    status = (
        F.when(key % 4 == 0, "deprecated").when(key % 4 == 1, "staging").otherwise("production")
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), size)
    return table(spark, sf_dir, "part").select(
        model_id.alias("model_id"),
        F.lit("pkl").alias("artifact_type"),
        version.alias("version"),
        day.alias("trained_date"),
        (size / 100.0).alias("model_drift_score"),
        status.alias("status"),
        F.format_string("Model_%s/", model_id).alias("azure_location"),
        features_of(size, F.round(size / 100.0, 2)).alias("expected_features"),
        day.cast("timestamp").alias("created_at"),
    )


_INPUT_ROWS = ", ".join(f"({i}, '{name}', '{kind}')" for i, name, kind in MODEL_INPUTS)

REGISTRY_SQL = f"""inputs(index, name, type) AS (VALUES {_INPUT_ROWS}),
    registry AS (
      SELECT 'm' || CAST(floor(p_partkey / 4) AS BIGINT) AS model_id, 'pkl' AS artifact_type,
             CASE WHEN p_partkey % 101 = 0 THEN '1.0'
                  ELSE '0.' || (p_size % 3) || '.' || (8 + p_partkey % 4) END AS version,
             DATE '2024-01-01' + CAST(p_size AS INTEGER) AS trained_date,
             p_size / CAST(100 AS DOUBLE) AS model_drift_score,
             CASE p_partkey % 4 WHEN 0 THEN 'deprecated' WHEN 1 THEN 'staging'
                  ELSE 'production' END AS status,
             'Model_m' || CAST(floor(p_partkey / 4) AS BIGINT) || '/' AS azure_location,
             p_size AS bits, p_partkey
      FROM part),
    ordered AS (
      SELECT *, [coalesce(TRY_CAST(x AS INTEGER), 0) FOR x IN string_split(version, '.')] AS sort_key
      FROM registry),
    newest AS (
      SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY sort_key DESC) AS place
        FROM ordered WHERE status = 'production') WHERE place = 1),
    model_features AS (
      SELECT r.model_id, r.version, r.status, r.model_drift_score, i.index, i.name AS feature_name, i.type
      FROM registry r JOIN inputs i ON (r.bits >> i.index) & 1 = 1)"""


# --- prediction log ----------------------------------------------------------------------


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one prediction; each 17th of them failed."""
    n = F.col("event_id")
    failed = n % 17 == 0
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")).alias("model_id"),
        F.concat(F.lit("0.1."), (n % 2).cast("string")).alias("model_version"),
        F.create_map(
            F.lit("k"),
            F.get_json_object("props", "$.k"),
            F.lit("action"),
            F.col("event_type"),
        ).alias("inputs"),
        F.when(failed, F.lit(-1.0)).otherwise(F.col("value")).alias("prediction"),
        F.when(failed, F.lit("Prediction failed")).alias("error"),
        F.col("ts").cast("timestamp").alias("predicted_at"),
    )


PREDICTION_SQL = """predictions AS (
      SELECT event_id, 'm' || (user_id % 5) AS model_id, '0.1.' || (event_id % 2) AS model_version,
             '{"action":"' || event_type || '","k":"' || (props ->> '$.k') || '"}' AS model_inputs,
             CASE WHEN event_id % 17 = 0 THEN CAST(-1 AS DOUBLE) ELSE value END AS prediction,
             CASE WHEN event_id % 17 = 0 THEN 'Prediction failed' ELSE '' END AS model_error,
             ts AS predicted_at
      FROM events)"""


def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True outcomes that arrive 0 to 4 days later, and for each seventh event never."""
    n = F.col("event_id")
    return (
        table(spark, sf_dir, "events")
        .filter(n % 7 != 0)
        .select(
            "event_id",
            (F.get_json_object("props", "$.k").cast("int") > 50).cast("int").alias("label"),
            (F.col("ts").cast("timestamp") + F.make_dt_interval(days=n % 5)).alias("labeled_at"),
        )
    )


LABEL_SQL = """late_labels AS (
      SELECT event_id, CASE WHEN CAST(props ->> '$.k' AS INTEGER) > 50 THEN 1 ELSE 0 END AS label,
             ts + to_days(CAST(event_id % 5 AS INTEGER)) AS labeled_at
      FROM events WHERE event_id % 7 <> 0)"""
