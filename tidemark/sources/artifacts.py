"""Model artifacts as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.registry import artifact_inventory


def artifact_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below the root: ``path`` relative to it, and ``content``.

    The content column is read only where a later step keeps it.
    """
    base = root.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.substring_index("path", base, -1).alias("path"), "length", "content")


def production_artifacts(spark: SparkSession, root: str, registry: DataFrame) -> DataFrame:
    """Bytes of every production artifact with its store key ``model:<id>:<ext>``.

    Paths are matched with the registry first, from a listing without content; the bytes are joined to what was found.
    """
    files = artifact_files(spark, root)
    found = artifact_inventory(registry, files.select("path", "length"))
    return files.select("path", "content").join(found, "path").select(*found.columns, "content")
