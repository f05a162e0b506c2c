"""Tables outside the log: parallel scans of a row store, and ad-hoc SQL."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.features import trailing_interval


def parallel_read_options(
    url: str, table: str, partition_column: str, low: str, high: str, partitions: int
) -> dict[str, str]:
    """Options of a JDBC scan that reads ranges of ``partition_column`` in parallel."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": low,
        "upperBound": high,
        "numPartitions": str(partitions),
        "pushDownPredicate": "true",
    }


def trailing_scan(
    spark: SparkSession,
    format: str,
    options: dict[str, str],
    interval: Column,
    as_of: Column,
    columns: list[str],
    time: str = "event_timestamp",
) -> DataFrame:
    """Rows of an external table newer than ``as_of - interval``.

    The filter and the column list reach the source; ``as_of`` is given, so the source is
    read once.
    """
    table = spark.read.format(format).options(**options).load()
    return trailing_interval(table, interval, as_of, time).select(*columns)


def json_rows(df: DataFrame) -> DataFrame:
    """Each result row as one JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("row"))


def query_as_json(spark: SparkSession, sql: str) -> tuple[DataFrame | None, str]:
    """Result rows of a SQL text as JSON, and an error text; analysis errors are returned, not raised."""
    try:
        return json_rows(spark.sql(sql)), ""
    except PySparkException as problem:
        return None, str(problem)
