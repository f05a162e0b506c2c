"""Which inputs a derived feature depends on, directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import cut_lineage


def dependency_closure(edges: DataFrame) -> DataFrame:
    """All (output, input) pairs reachable over edges ``output``, ``input``, with the least depth.

    Each round joins only the pairs found in the round before and stops when nothing new
    appears, so the number of rounds is the depth of the graph; cycles end too. Rounds are cut
    by checkpoints.
    """
    edges = cut_lineage(edges.select("output", "input").distinct())
    known = edges.withColumn("depth", F.lit(1))
    fresh, depth = known, 1
    while True:
        depth += 1
        step = (
            fresh.alias("f")
            .join(edges.alias("e"), F.col("f.input") == F.col("e.output"))
            .select("f.output", "e.input")
            .distinct()
        )
        fresh = cut_lineage(
            step.join(known, ["output", "input"], "left_anti").withColumn("depth", F.lit(depth))
        )
        if fresh.isEmpty():
            return known
        known = cut_lineage(known.unionByName(fresh))
