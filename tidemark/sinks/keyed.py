"""A table with one row per key that is kept up to date by batches.

Each batch adds a run: its rows, one per key, divided into buckets by the hash of the key. Runs of a
level are merged into one of the next level when there are ``fan`` of them, those of the last level
into one of the same, so a reader meets at most ``fan * levels`` runs however many batches there were,
and a row is rewritten about ``levels`` times.

What makes up the table stands in a pointer (:mod:`tidemark.sinks.pointer`), which is switched in one step,
so a reader finds a whole version at any moment, and a run of work that is broken off changes nothing.
Folders of runs are taken again in a ring, the oldest first; nothing needs to be deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks import pointer as pointer_file

POINTER = (
    "version long, batch long, runs array<struct<level:int,slot:int>>, used array<int>, facts map<string,long>"
)


@dataclass(frozen=True)
class Pointer:
    """The version that readers see: last batch applied, runs, next folder per level, and facts of the writer."""

    version: int
    batch: int
    runs: tuple[tuple[int, int], ...]
    used: tuple[int, ...]
    facts: dict[str, int]


@dataclass(frozen=True)
class KeyedStore:
    """``merge`` makes one row per key out of several; the order of its rows must not matter.

    One writer at a time. A reader may go on with the version it began with while ``kept`` more runs
    are written to each level.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    buckets: int = 32
    fan: int = 4
    levels: int = 4
    kept: int = 60

    def _file(self) -> pointer_file.Pointer:
        return pointer_file.Pointer(self.spark, f"{self.path}/pointer", POINTER)

    def pointer(self) -> Pointer:
        """The newest version; version 0, without rows, where nothing was written yet."""
        newest = self._file().newest()
        if newest is None:
            return Pointer(0, -1, (), (0,) * self.levels, {})
        runs = tuple((run["level"], run["slot"]) for run in newest["runs"])
        return Pointer(newest["version"], newest["batch"], runs, tuple(newest["used"]), dict(newest["facts"] or {}))

    def _publish(self, pointer: Pointer) -> None:
        self._file().publish((pointer.version, pointer.batch, list(pointer.runs), list(pointer.used), pointer.facts))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _written(self, rows: DataFrame, level: int, pointer: Pointer) -> Pointer:
        """``rows`` as a new run; the pointer returned names it, but is not published."""
        slot = pointer.used[level] % (self.fan + self.kept)
        laid = rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        laid.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/runs/level={level}/slot={slot}")
        used = tuple(n + (at == level) for at, n in enumerate(pointer.used))
        return replace(pointer, runs=(*pointer.runs, (level, slot)), used=used)

    def _rows(self, runs: tuple[tuple[int, int], ...]) -> DataFrame:
        schema = f"{self.schema}, level int, slot int, bucket int"
        paths = [f"{self.path}/runs/level={level}/slot={slot}" for level, slot in runs]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/runs").parquet(*paths)

    def apply(self, rows: DataFrame, batch: int, **facts: int) -> bool:
        """Merge a batch and publish the new version; a batch that was applied before changes nothing.

        ``facts`` are stored with the version. Returns whether there is a new version.
        """
        pointer = self.pointer()
        if batch <= pointer.batch:
            return False
        self._add(rows, replace(pointer, batch=batch, facts=pointer.facts | facts))
        return True

    def amend(self, rows: DataFrame, **facts: int) -> None:
        """Merge rows that belong to no batch. ``facts`` is where the caller notes that this was done."""
        pointer = self.pointer()
        self._add(rows, replace(pointer, facts=pointer.facts | facts))

    def _add(self, rows: DataFrame, pointer: Pointer) -> None:
        pointer = self._written(self.merge(rows), 0, pointer)
        for level in range(self.levels):
            full = tuple(run for run in pointer.runs if run[0] == level)
            if len(full) >= self.fan:
                rest = replace(pointer, runs=tuple(run for run in pointer.runs if run[0] != level))
                merged = self.merge(self._rows(full).drop("level", "slot", "bucket"))
                pointer = self._written(merged, min(level + 1, self.levels - 1), rest)
        self._publish(replace(pointer, version=pointer.version + 1))

    def read(self) -> DataFrame:
        """One row per key, as of the version published now."""
        return self.merge(self._rows(self.pointer().runs).drop("level", "slot", "bucket"))

    def lookup(self, asked: DataFrame) -> DataFrame:
        """Rows of the keys in ``asked``; only the buckets that hold them are read."""
        keys = asked.select(*self.keys).distinct()
        # At most ``buckets`` numbers.
        wanted = [row[0] for row in keys.select(self._bucket().alias("bucket")).distinct().collect()]
        rows = self._rows(self.pointer().runs).filter(F.col("bucket").isin(wanted)).drop("level", "slot", "bucket")
        return self.merge(rows.join(keys, list(self.keys), "left_semi"))
