"""The name of a table's present version, switched in one step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession


@dataclass(frozen=True)
class Pointer:
    """One row, which is one small file, in two folders that take turns.

    While one is replaced the other still names the version before, so a reader finds one or the other
    at any moment. ``schema`` begins with ``version long``. One writer at a time.
    """

    spark: SparkSession
    path: str
    schema: str

    def newest(self) -> Row | None:
        try:
            # A file that is being replaced may vanish under the reader; the other one stays.
            rows = self.spark.read.schema(self.schema).option("ignoreMissingFiles", "true").json(self.path).collect()
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        return max((row for row in rows if row["version"] is not None), key=lambda row: row["version"], default=None)

    def publish(self, row: tuple) -> None:
        one = self.spark.createDataFrame([row], self.schema).coalesce(1)
        one.write.mode("overwrite").json(f"{self.path}/turn={row[0] % 2}")
