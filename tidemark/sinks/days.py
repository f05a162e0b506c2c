"""A log of features by day whose days are replaced in one step.

Every write is a new version in a folder of its own. A manifest says which features and days each version
replaces; rows of older versions are hidden there. Readers filter by partition columns alone, so hidden
files are not opened. The manifest is switched by a pointer: a reader during a backfill sees the old days
or the new ones, never a part, and a run that is broken off leaves the old ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.pointer import Pointer
from tidemark.sinks.writers import PARTITIONS, laid_out

MANIFEST = "version long, used long, entries array<struct<folder:long,first:date,until:date,features:array<string>>>"


@dataclass(frozen=True)
class DayTable:
    """``schema`` is that of the rows. Rows without a feature or a time lie in partitions of their own and are replaced by none."""

    spark: SparkSession
    path: str
    schema: str

    def _pointer(self) -> Pointer:
        return Pointer(self.spark, f"{self.path}/manifest", MANIFEST)

    def _add(self, rows: DataFrame, first: date | None, until: date | None, features: list[str] | None) -> None:
        row = self._pointer().newest()
        version, used, entries = (0, 0, []) if row is None else (row["version"], row["used"], [tuple(e) for e in row["entries"]])
        # A folder of a broken run is written over.
        laid_out(rows).write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{self.path}/rows/folder={used}")
        self._pointer().publish((version + 1, used + 1, [*self._needed(entries, first, until, features), (used, first, until, features)]))

    @staticmethod
    def _needed(entries: list[tuple], first: date | None, until: date | None, features: list[str] | None) -> list[tuple]:
        """Entries that a new one does not hide as a whole: earlier replacements of the same features and days go."""

        def hidden(entry: tuple) -> bool:
            if first is None or entry[1] is None:
                return False
            days = first <= entry[1] and entry[2] <= until
            return days and (features is None or (entry[3] is not None and set(entry[3]) <= set(features)))

        return [entry for entry in entries if not hidden(entry)]

    def append(self, rows: DataFrame) -> None:
        self._add(rows, None, None, None)

    def replace(self, rows: DataFrame, first: date, until: date, features: list[str] | None = None) -> None:
        """Replace the days from ``first`` to before ``until``, of all features or of those named, by ``rows``, which lie there."""
        self._add(rows, first, until, features)

    def read(self) -> DataFrame:
        """All rows that no later version replaces, as of the version published now."""
        row = self._pointer().newest()
        schema = f"{self.schema}, event_date date, folder long"
        names = self.spark.createDataFrame([], self.schema).columns
        if row is None:
            return self.spark.createDataFrame([], schema).select(*names, "event_date")
        paths = [f"{self.path}/rows/folder={entry['folder']}" for entry in row["entries"]]
        found = self.spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*paths)
        return found.filter(~self._hidden(row["entries"])).select(*names, "event_date")

    @staticmethod
    def _hidden(entries: list) -> Column:
        def by(entry) -> Column:
            older = F.col("folder") < entry["folder"]
            days = (F.col("event_date") >= F.lit(entry["first"])) & (F.col("event_date") < F.lit(entry["until"]))
            own = F.lit(True) if entry["features"] is None else F.col("feature_name").isin(*entry["features"])
            return older & F.coalesce(days & own, F.lit(False))

        return reduce(lambda a, b: a | b, [by(entry) for entry in entries if entry["first"] is not None], F.lit(False))
