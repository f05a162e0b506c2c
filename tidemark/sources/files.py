"""Event files: JSON arrays and parquet, chosen by extension; the rest is listed as rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import file_extension
from tidemark.schemas import FEATURE_EVENT
from tidemark.sources.messages import to_log

# The file types that are read.
SUPPORTED = ("json", "parquet")


def read_json_events(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of events."""
    return (
        spark.read.schema(FEATURE_EVENT)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )


def read_parquet_events(spark: SparkSession, path: str) -> DataFrame:
    """Columns by name, with their timestamps."""
    return spark.read.schema(FEATURE_EVENT).option("pathGlobFilter", "*.parquet").parquet(path)


def read_event_folder(spark: SparkSession, path: str) -> DataFrame:
    """All supported files of a folder as log rows, each with the reader of its extension."""
    return to_log(read_json_events(spark, path).unionByName(read_parquet_events(spark, path)))


def rejected_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of the folder that no reader takes; only names are read, no content."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return (
        listing.select("path", F.lower(file_extension(F.col("path"))).alias("extension"))
        .filter(~F.col("extension").isin(*SUPPORTED))
        .withColumn("error", F.concat(F.lit("unsupported file type: "), F.col("extension")))
    )


def insert_from_file(spark: SparkSession, table: str, path: str) -> None:
    """Append a parquet file to a table, columns matched by name."""
    columns = spark.table(table).columns
    spark.read.parquet(path).select(*columns).write.insertInto(table)
