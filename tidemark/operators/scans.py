"""Running maxima along the axis of each key, however the rows are spread over keys and moments.

All rows are dealt to ranges of (key, moment), which come out even whatever a key holds: one key, one
second of a key, may fill any number of ranges. A maximum runs within each range, and what the ranges
before know of a range's first key is added afterwards. Only that is small: one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import stored


def dealt(axis: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows with the number of their range (``part``), written once, and each range's first and last key.

    Ranges follow one another in the order of ``keys`` and ``order``; equal rows share a range.
    """
    wanted = [] if ranges is None else [ranges]
    placed = axis.repartitionByRange(*wanted, *keys, *order).withColumn("part", F.spark_partition_id())
    rows = stored(placed, "axis")
    key = F.struct(*keys)
    ends = rows.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    return rows, stored(ends, "ends")


def of_last_key(rows: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each range that belong to its last key: all that later ranges can need of it."""
    # One row per range.
    last = F.broadcast(ends.select("part", *[F.col(f"last.{key}").alias(key) for key in keys]))
    return rows.join(last, ["part", *keys])


def running_max(points: DataFrame, asks: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """Rows (keys..., at, state): for each distinct ask the largest state of its key's points up to it.

    ``points`` has the keys, ``at`` and ``state``, ``asks`` the keys and ``at``. With ``strict`` only points before the
    ask count. Asks without such a point have a null state; rows with a null key or moment are left out.
    """
    ask_side, point_side = (0, 1) if strict else (1, 0)
    known = points.dropna(subset=[*keys, "at"]).select(*keys, "at", F.lit(point_side).alias("side"), "state")
    wanted = asks.dropna(subset=[*keys, "at"]).select(*keys, "at").distinct()
    axis = known.unionByName(wanted.withColumn("side", F.lit(ask_side)), allowMissingColumns=True)
    rows, ends = dealt(axis, keys, ["at", "side", "state"])
    upto = Window.partitionBy("part", *keys).orderBy("at", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumn("state", F.max("state").over(upto)).filter(F.col("side") == ask_side)
    tails = of_last_key(rows, ends, keys).groupBy("part", *keys).agg(F.max("state").alias("state"))
    heads = ends.select("part", *[F.col(f"first.{key}").alias(key) for key in keys])
    # Both have one row per range; a range's own tail stands after its head.
    chain = heads.withColumn("tail", F.lit(0)).unionByName(tails.withColumn("tail", F.lit(1)), allowMissingColumns=True)
    earlier = Window.partitionBy(*keys).orderBy("part", "tail").rowsBetween(Window.unboundedPreceding, -1)
    carried = chain.withColumn("carried", F.max("state").over(earlier)).filter("tail = 0").select("part", *keys, "carried")
    both = inside.join(F.broadcast(carried), ["part", *keys], "left")
    return both.select(*keys, "at", F.greatest("state", "carried").alias("state"))
