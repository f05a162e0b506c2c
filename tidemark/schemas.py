"""Schemas of the feature log, the model registry, the prediction log and their messages."""

from pyspark.sql import types as T

# An event as it arrives, from a stream message or inside a file.
FEATURE_EVENT = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("validated_at", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# The append-only offline log. event_timestamp is event time, created_at is knowledge time.
FEATURE_LOG = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

EXPECTED_FEATURE = T.StructType(
    [
        T.StructField("index", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("drift_score", T.DoubleType()),
    ]
)

# One row per model version.
MODEL_METADATA = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("artifact_type", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("trained_date", T.DateType()),
        T.StructField("model_drift_score", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("azure_location", T.StringType()),
        T.StructField("expected_features", T.ArrayType(EXPECTED_FEATURE)),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# One row per prediction. Inputs are JSON text because their types differ by model.
MODEL_LOG = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("model_inputs", T.StringType()),
        T.StructField("model_result", T.StringType()),
        T.StructField("model_error", T.StringType()),
        T.StructField("event_datetime", T.TimestampType()),
    ]
)
