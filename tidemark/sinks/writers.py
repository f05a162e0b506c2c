"""Writers: offline log, multi-table envelopes, snapshots and baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import rfc3339
from tidemark.runtime import once

PARTITIONS = ["feature_name", "event_date"]


def laid_out(rows: DataFrame) -> DataFrame:
    """Rows gathered by feature and date for writing.

    Rebalancing divides a feature and date with very many rows over several writers at run time
    and joins small ones, so files come out at an even size.
    """
    dated = rows.withColumn("event_date", F.to_date("event_timestamp"))
    return dated.hint("rebalance", *[F.col(name) for name in PARTITIONS])


def append_offline(rows: DataFrame, path: str) -> None:
    """Append log rows to parquet partitioned by feature and date."""
    laid_out(rows).write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def replace_days(rows: DataFrame, path: str) -> None:
    """Replace exactly the feature and date partitions that ``rows`` contains.

    Writing the same rows again leaves the table as it is.
    """
    (
        laid_out(rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def opened(envelopes: DataFrame) -> DataFrame:
    """Envelopes with their parsed ``head``: the table's name and the fields as texts.

    ``envelopes`` has a text column ``message``: ``{"table": ..., "data": {...}}``.
    """
    head = F.from_json("message", "table string, data map<string,string>")
    return envelopes.select("message", once(head).alias("head"))


def _fields(schema: T.StructType) -> tuple[list[Column], list[Column]]:
    """The fields of a table out of an envelope's texts, and the texts; a missing field is null, an extra one is dropped."""
    columns, texts = [], []
    for field in schema.fields:
        raw = F.col("head.data")[field.name]
        if isinstance(field.dataType, T.TimestampType):
            read = rfc3339(raw)
        elif isinstance(field.dataType, T.StringType):
            read = raw
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            read = F.from_json(raw, field.dataType)
        else:
            read = raw.try_cast(field.dataType)
        columns.append(read.alias(field.name))
        texts.append(raw)
    return columns, texts


def _misfits(schema: T.StructType, row: str) -> list[Column]:
    """For each field an error where its text does not fit its type."""
    return [
        F.when(raw.isNotNull() & F.col(f"{row}.{field.name}").isNull(), F.lit(f"bad {field.name}"))
        for field, raw in zip(schema.fields, _fields(schema)[1])
    ]


def route_envelopes(envelopes: DataFrame, schemas: dict[str, T.StructType], path: str, mode: str = "append") -> None:
    """Write the rows of all tables, and what is unusable, in one pass and one job.

    The parquet at ``path`` is partitioned by ``target``: a table's name, or empty for dead letters. Each table has a
    struct column of its own type, which costs nothing where it is null; :func:`routed` reads it as a table.
    ``mode="overwrite"`` is for a path that belongs to this batch alone, which a retry writes anew.
    """
    parsed = opened(envelopes)
    read = {table: F.struct(*_fields(schema)[0]) for table, schema in schemas.items()}
    named = F.col("head.table")
    own = [F.when(named == table, row).alias(f"row_{i}") for i, (table, row) in enumerate(read.items())]
    rows = parsed.select("message", "head", once(F.struct(*own)).alias("rows"))
    error = F.when(named.isNull(), "no table").when(~named.isin(*schemas), F.concat(F.lit("unknown table "), named))
    for i, (table, schema) in enumerate(schemas.items()):
        error = error.when(named == table, F.coalesce(*_misfits(schema, f"rows.row_{i}"), F.lit(None).cast("string")))
    judged = rows.withColumn("error", error)
    fine = F.col("error").isNull()
    judged.select(
        F.when(fine, named).otherwise("").alias("target"),
        F.when(~fine, F.col("message")).alias("message"),
        "error",
        *[F.when(fine, F.col(f"rows.row_{i}")).alias(table) for i, table in enumerate(schemas)],
    ).write.mode(mode).partitionBy("target").parquet(path)


def _routed(spark: SparkSession, schemas: dict[str, T.StructType], path: str) -> DataFrame:
    columns = T.StructType([T.StructField("message", T.StringType()), T.StructField("error", T.StringType())])
    for table, schema in schemas.items():
        columns = columns.add(table, schema)
    return spark.read.schema(columns.add("target", T.StringType())).parquet(path)


def routed(spark: SparkSession, schemas: dict[str, T.StructType], path: str, table: str) -> DataFrame:
    """One table out of what :func:`route_envelopes` wrote: only its partition and its column are read."""
    return _routed(spark, schemas, path).filter(F.col("target") == table).select(f"`{table}`.*")


def refused(spark: SparkSession, schemas: dict[str, T.StructType], path: str) -> DataFrame:
    """The dead letters of :func:`route_envelopes` with what was wrong."""
    # An empty partition value is read back as null.
    return _routed(spark, schemas, path).filter(F.col("error").isNotNull()).select("message", "error")


def publish(snapshot_rows: DataFrame, path: str) -> None:
    """Replace the published registry snapshot."""
    snapshot_rows.write.mode("overwrite").parquet(path)


def save_baseline(baseline: DataFrame, path: str) -> None:
    """Baseline statistics as JSON lines, one per feature."""
    baseline.write.mode("overwrite").json(path)
