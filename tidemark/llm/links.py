"""Texts linked by exact Jaccard similarity, among those that share a band.

A band's group is not paired with itself at once. Members of small groups meet each other, those of large
ones meet the group's leader; pairs that their marks (small summaries of a text's shingles) do not rule out are
verified on the texts. Members of large groups that are still in different components then meet within the group: of
the pairs between two components one is verified first, the others where the two are still apart.

The members of all bands are grouped in several passes, so that they are never there at once; what shares a band, far less,
is compared in one step.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.runtime import handed_on, lifetime, once, stored

# Groups up to this size are compared whole in the first step.
SMALL = 8
# A larger group is divided into blocks of about this many members; each two blocks meet in a place of their own.
BLOCK = 4_096


def verified(pairs: DataFrame, lines: DataFrame, least: float, shingles: Callable[[str], Column]) -> DataFrame:
    """Of (one, two), those whose lines have exact Jaccard similarity ``least`` or more.

    The distinct lines are read where they lie: the keys asked for, by far fewer, come to them and are
    hashed, so that the lines need not be sorted.
    """
    with lifetime(lines.sparkSession):
        pairs = stored(pairs, "pairs")
        keys = pairs.select(F.explode(F.array("one", "two")).alias("line_key")).distinct()
        asked = stored(lines.join(keys.hint("shuffle_hash"), "line_key", "left_semi"), "asked", compression="zstd")
        left = asked.select(F.col("line_key").alias("one"), F.col("line").alias("line_one"))
        right = asked.select(F.col("line_key").alias("two"), F.col("line").alias("line_two"))
        both = pairs.join(left, "one").join(right, "two")
        sets = both.select("one", "two", "line_two", once(shingles("line_one")).alias("set_one"))
        sets = sets.select("one", "two", "set_one", once(shingles("line_two")).alias("set_two"))
        total = (F.size("set_one") + F.size("set_two")).alias("total")
        met = sets.select("one", "two", total, once(F.size(F.array_intersect("set_one", "set_two"))).alias("common"))
        alike = met.where(F.col("common") >= least * (F.col("total") - F.col("common")))
        return handed_on(alike.select("one", "two"), "links")


def _shared(prints: DataFrame, bands: list[Column]) -> DataFrame:
    """Rows (band, line_key, size, leader) of the bands that several texts share; the leader is the least key of the group."""
    members = prints.select("line_key", F.explode(F.array(*bands)).alias("band")).repartition("band")
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("line_key").alias("leader"))
    return members.join(sizes.where("size > 1").hint("shuffle_hash"), "band")


def _led(shared: DataFrame) -> DataFrame:
    """The rows of large groups, with the leader that shares these groups with most others, of such the one with the least key.

    Of near copies of a text it is the text itself, to which more of them are similar than to each other.
    """
    large = shared.where(F.col("size") > SMALL).select("band", "line_key", "size")
    weights = large.groupBy("line_key").agg(F.sum("size").alias("weight"))
    ranked = large.join(weights.hint("shuffle_hash"), "line_key")
    leaders = ranked.groupBy("band").agg(F.min(F.struct((-F.col("weight")).alias("weight"), "line_key")).alias("first"))
    return large.join(leaders.select("band", F.col("first.line_key").alias("leader")), "band")


def _sides(held: DataFrame, *same: str) -> tuple[DataFrame, DataFrame]:
    # Both sides read the rows as they were dealt, one time.
    one = held.select(*[F.col(c).alias(c if c in same else f"{c}_one") for c in held.columns])
    return one, held.select(*[F.col(c).alias(c if c in same else f"{c}_two") for c in held.columns])


def _first_pairs(shared: DataFrame, prints: DataFrame, marks: list[str], may: Column) -> DataFrame:
    """Pairs (one, two) of small groups, and of the leaders of large ones with the other members, that may be linked."""
    held = prints.select("line_key", *marks).join(shared.hint("shuffle_hash"), "line_key").repartition("band")
    one, two = _sides(held, "band")
    leads = F.col("line_key_one") == F.col("leader_one")
    one = one.where((F.col("size_one") <= SMALL) | leads)
    # A leader meets all others, members of small groups those of larger keys; what meets the leader is not met again.
    once_each = (F.col("line_key_one") != F.col("line_key_two")) & (
        leads | ((F.col("line_key_one") < F.col("line_key_two")) & (F.col("line_key_two") != F.col("leader_two")))
    )
    met = one.join(two, (one["band"] == two["band"]) & once_each & may)
    ends = F.col("line_key_one"), F.col("line_key_two")
    return met.select(F.least(*ends).alias("one"), F.greatest(*ends).alias("two")).distinct()


def _open(large: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (band, line_key, size, component) of the large groups that hold more than one component, their leaders aside."""
    rest = large.where(F.col("line_key") != F.col("leader")).select("band", "line_key", "size")
    placed = rest.join(known.withColumnRenamed("node", "line_key"), "line_key", "left").withColumn("component", F.coalesce("component", "line_key"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return placed.join(mixed.select("band"), "band")


def _apart(asked: DataFrame, prints: DataFrame, marks: list[str], may: Column) -> DataFrame:
    """Rows (low, high, one, two): pairs of open groups in different components that may be linked."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(3), "line_key"), blocks).cast("int")
    # Two blocks meet in one cell, a block with itself in another: every pair meets once.
    cells = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")))
    placed = asked.select("band", "line_key", "component", own.alias("own"), F.explode(cells).alias("cell"))
    held = prints.select("line_key", *marks).join(placed.hint("shuffle_hash"), "line_key").repartition("band", "cell")
    one, two = _sides(held, "band", "cell")
    across = (F.col("own_one") != F.col("own_two")) | (F.col("cell.i") == F.col("cell.j"))
    met = one.join(two, ["band", "cell"]).where(
        (F.col("line_key_one") < F.col("line_key_two")) & (F.col("component_one") != F.col("component_two")) & across & may
    )
    low, high = F.least("component_one", "component_two"), F.greatest("component_one", "component_two")
    return met.select(low.alias("low"), high.alias("high"), F.col("line_key_one").alias("one"), F.col("line_key_two").alias("two"))


def as_links(known: DataFrame) -> DataFrame:
    return known.select(F.col("node").alias("one"), F.col("component").alias("two"))


def _renamed(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of components (low, high) by the components they are in now, without those that have become one."""
    for end in ("low", "high"):
        pairs = pairs.join(known.select(F.col("node").alias(end), F.col("component").alias("now")), end, "left")
        pairs = pairs.withColumn(end, F.coalesce("now", end)).drop("now")
    return pairs.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")).where("low < high").distinct()


def linked(
    texts: DataFrame, prints: DataFrame, bands: list[Column], marks: list[str], may: Column, least: float,
    shingles: Callable[[str], Column], passes: int = 4, summary: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows (node, component) of the distinct ``texts`` (line_key, line) that are linked to another one.

    ``prints`` has a row for each text: ``line_key``, the columns of ``bands`` and ``marks``; both tables are bucketed by the key.
    ``may`` says of the marks with suffixes _one and _two whether the texts can be linked; pairs it admits are verified by the
    exact similarity of their ``shingles``. With ``summary`` the marks are what it gives for the texts that share a band, and
    ``prints`` has none; it may then have several rows for a text.
    """
    every = -(-len(bands) // passes)
    with lifetime(texts.sparkSession):
        passed = [stored(_shared(prints, bands[begin : begin + every]), "shared") for begin in range(0, len(bands), every)]
        shared = reduce(DataFrame.unionByName, passed)
        if summary:
            keys = shared.select("line_key").distinct()
            prints = stored(summary(texts.join(keys.hint("shuffle_hash"), "line_key", "left_semi")), "marks")
        large = stored(_led(shared), "large")
        groups = shared.where(F.col("size") <= SMALL).unionByName(large)
        known = components(verified(_first_pairs(groups, prints, marks, may), texts, least, shingles), "one", "two")
        asked = stored(_open(large, known), "open")
        # One pair of each two components that may be linked: a group of many links is not written out.
        pair = F.xxhash64("one", "two")
        apart = _apart(asked, prints, marks, may).groupBy("low", "high")
        some = apart.agg(F.min("one").alias("one"), F.min_by("two", "one").alias("two"), (F.min(pair) < F.max(pair)).alias("several"))
        some = stored(some, "apart")
        if some.isEmpty():
            return handed_on(known, "linked")
        links = verified(some.select("one", "two").distinct(), texts, least, shingles)
        known = stored(components(as_links(known).unionByName(links), "one", "two"), "known")
        left = stored(_renamed(some.where("several").select("low", "high"), known), "left")
        if left.isEmpty():
            return handed_on(known, "linked")
        now = _open_now(asked, known, left)
        both = _apart(now, prints, marks, may).join(left, ["low", "high"], "left_semi")
        links = verified(both.select("one", "two").distinct(), texts, least, shingles)
        return handed_on(components(as_links(known).unionByName(links), "one", "two"), "linked")


def _open_now(members: DataFrame, known: DataFrame, left: DataFrame) -> DataFrame:
    """The members by their present components, of those that ``left`` names."""
    now = members.join(known.select(F.col("node").alias("line_key"), F.col("component").alias("now")), "line_key", "left")
    now = now.withColumn("component", F.coalesce("now", "component")).drop("now")
    named = left.select(F.explode(F.array("low", "high")).alias("component")).distinct()
    return now.join(named, "component", "left_semi")
