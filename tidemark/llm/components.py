"""Connected components of a link table by alternating large and small stars.

Both steps are a map-side combined minimum per node and an equi-join, so a node with any number
of links spreads over many tasks (adaptive execution splits the skewed side of the join). The
number of rounds is logarithmic in the number of nodes; every round starts from a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import stored


def _round(edges: DataFrame) -> DataFrame:
    """One large star, then one small star; edges are (high, low) with high > low."""
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
    large = both.join(least, "node").where("other > node").select(F.col("other").alias("high"), F.col("least").alias("low"))
    large = large.where("high > low").distinct()
    lowest = large.groupBy("high").agg(F.min("low").alias("least"))
    joined = large.join(lowest, "high")
    small = joined.where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return small.unionByName(lowest.select("high", F.col("least").alias("low"))).distinct()


def components(links: DataFrame, one: str, two: str) -> DataFrame:
    """Rows (node, component) for every node that has a link to another one.

    ``component`` is the smallest node reachable. Links with a null end and links of a node to
    itself are left out; repeated links and either direction give the same result; without links
    the result is empty. Nodes without links are not listed: they are their own component.
    """
    edges = (
        links.where(F.col(one).isNotNull() & F.col(two).isNotNull() & (F.col(one) != F.col(two)))
        .select(F.greatest(one, two).alias("high"), F.least(one, two).alias("low"))
        .distinct()
    )
    state, before = stored(edges, "links"), None
    while True:
        facts = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if not facts[0] or tuple(facts) == before:
            break
        before = tuple(facts)
        state = stored(_round(state), "links")
    nodes = state.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = state.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return nodes.unionByName(roots)
