"""Rows at given ranks, found without sorting a whole group.

A window that numbers every row of a group sorts that group in one task, and one group may hold
a third of the data. Here a quantile sketch of the rows, which merges map-side, gives GRID + 1 splitters, and a
wanted rank lies between two of them that hold about 1/100 of the rows. One exact count of what
lies below, at, between and above these two tells where the rank is, whatever the sketch got wrong; the next round
looks at that part alone. A round divides rows, not the range of the keys: a box of n rows is down to ``small_box`` after
about log(n / small_box) / log(100) rounds (four for a billion rows), for any values. Rows at the splitters are
counted apart, so ties cannot hold a round up, and since the ends of a box are splitters it loses them at least.
What reaches the driver is one summary row per round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.runtime import settled, small

# Splitters of a box, and the accuracy of the sketch they come from.
GRID = 256
ACCURACY = 1024
ROUND_BINS = 1024
# A box with at most this many rows is finished by counting its distinct keys.
SMALL_BOX = 10_000


def fine_bin(key: Column, low: Column, high: Column, bins: int = ROUND_BINS) -> Column:
    """Equal-width bin that never decreases with the key; a single-valued range is bin 0.

    Halves are taken first: the difference of two finite doubles may be none.
    """
    position = (key / 2 - low / 2) / (high / 2 - low / 2) * F.lit(float(bins))
    return F.when(low / 2 < high / 2, F.least(F.floor(position), F.lit(bins - 1))).otherwise(F.lit(0))


def splitters(key: Column | str) -> Column:
    """Aggregate: GRID + 1 ascending values that divide the rows about evenly, the least and the greatest among them."""
    return F.percentile_approx(key, [i / GRID for i in range(GRID + 1)], ACCURACY)


def splitter_number(key: Column, grid: Column) -> Column:
    """Where a key lies among splitters: keys equal to one have a number of their own, apart from those between two."""
    block = 16
    edges = F.transform(F.sequence(F.lit(0), F.lit(GRID // block)), lambda i: F.get(grid, i * block))

    def count(before) -> Column:
        whole = F.size(F.filter(edges, before))
        return (whole - 1) * block + F.size(F.filter(F.slice(grid, F.greatest(whole - 1, F.lit(0)) * block + 1, block), before))

    def counted(before) -> Column:
        return F.when(before(F.get(grid, F.lit(0))), count(before)).otherwise(0)

    return counted(lambda x: x < key) + counted(lambda x: x <= key)


def _pick(counted: DataFrame, box: list[str], order: list[str]) -> DataFrame:
    """Of each box the counted part that contains the rank, with the rank made relative to it."""
    running = Window.partitionBy(*box).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.withColumn("upto", F.sum("rows").over(running))
        .filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("rows")))
        .withColumn("rank", F.col("rank") - (F.col("upto") - F.col("rows")))
        .drop("upto")
    )


def _counted(
    rows: DataFrame,
    boxes: DataFrame,
    facts: Row,
    group: list[str],
    pinned: list[str],
    key: str,
    parts: list[Column],
    measures: list[Column],
) -> DataFrame:
    """Boxes with the counted parts of the rows inside them.

    A row is inside when it has the box's group and pinned keys and its key lies in the box's
    range. Several ranks may share a box: its rows are counted once and then given to each.
    """
    area = [*group, *pinned, "low", "high"]
    areas = boxes.filter("leads").select(*area).withColumnsRenamed(
        {"low": "area_low", "high": "area_high", **{k: f"at_{k}" for k in pinned}}
    )
    held = rows.filter(
        F.col(key).between(F.lit(facts["low"]), F.lit(facts["high"]))
    ).join(small(areas, facts["rows"]), group)
    held = held.filter(F.col(key).between(F.col("area_low"), F.col("area_high")))
    for name in pinned:
        held = held.filter(F.col(name) == F.col(f"at_{name}")).drop(f"at_{name}")
    counts = held.groupBy(*group, *pinned, "area_low", "area_high", *parts).agg(
        F.count(F.lit(1)).alias("rows"), *measures
    )
    asked = boxes.select(
        *group, *pinned, "cut", "rank", F.col("low").alias("area_low"), F.col("high").alias("area_high")
    )
    return counts.join(small(asked, facts["rows"]), [*group, *pinned, "area_low", "area_high"])


def _regions(rows: DataFrame, around: DataFrame, facts: Row, group: list[str], pinned: list[str], key: str) -> DataFrame:
    """Of each rank's box the counts below, at, between and above the two splitters around the rank."""
    around, _ = settled(around.withColumnsRenamed({k: f"at_{k}" for k in pinned}).drop("rows"))
    held = rows.filter(F.col(key).between(F.lit(facts["low"]), F.lit(facts["high"]))).join(small(around, facts["rows"]), group)
    held = held.filter(F.col(key).between(F.col("area_low"), F.col("area_high")))
    for name in pinned:
        held = held.filter(F.col(name) == F.col(f"at_{name}")).drop(f"at_{name}")
    low, high = F.col("from"), F.col("to")
    region = F.when(F.col(key) < low, 0).when(F.col(key) == low, 1).when(F.col(key) < high, 2).when(F.col(key) == high, 3).otherwise(4)
    return held.groupBy(*group, *pinned, "cut", "rank", region.alias("region")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")
    )


def rank_cuts(
    rows: DataFrame,
    group: list[str],
    keys: list[str],
    wanted: DataFrame,
    small_box: int = SMALL_BOX,
) -> DataFrame:
    """Key at each wanted zero-based rank, in ascending order of ``keys`` within the group.

    ``keys`` are long or double columns without nulls. ``wanted`` holds the group columns,
    ``cut`` (a label), ``rank``, ``rows`` (size of the group) and ``low``/``high`` (range of the
    first key in the group). The result holds the group columns, ``cut``, ``at`` (struct of the
    keys), ``skip`` (rows with the same keys that come before the rank) and ``copies`` (rows with
    these keys). A rank past the end has no row.
    """
    rows = rows.select(*group, *keys)
    large = F.col("rows") > small_box
    several = F.col("low") < F.col("high")

    def settle(boxes: DataFrame) -> tuple[DataFrame, Row]:
        same_box = Window.partitionBy(*group, *pinned, "low", "high").orderBy("cut")
        return settled(
            boxes.withColumn("leads", F.row_number().over(same_box) == 1),
            low=F.min("low"),
            high=F.max("high"),
            wide=F.count_if(large & several),
            tied=F.count_if(large & ~several),
        )

    boxes = wanted.filter(F.col("rank") < F.col("rows")).select(
        *group, "cut", "rank", "rows", "low", "high"
    )
    result: DataFrame | None = None
    pinned: list[str] = []
    for position, key in enumerate(keys):
        boxes, facts = settle(boxes)
        while facts["wide"]:
            open_boxes = boxes.filter(large & several)
            grids = _counted(rows, open_boxes, facts, group, pinned, key, [], [splitters(key).alias("grid")])
            place = F.floor(F.col("rank") / F.col("rows") * GRID).cast("int")
            # The rows of a box are counted again here: ``rows`` of the sketch are those of the box.
            around = grids.select(
                *group, *pinned, "cut", "rank", "rows", "area_low", "area_high",
                F.get("grid", F.greatest(place - 1, F.lit(0))).alias("from"),
                F.get("grid", F.least(place + 2, F.lit(GRID))).alias("to"),
            )
            narrowed = _pick(_regions(rows, around, facts, group, pinned, key), [*group, "cut"], ["region"]).drop("region")
            boxes, facts = settle(boxes.filter(~(large & several)).drop("leads").unionByName(narrowed))
        last = position == len(keys) - 1
        finished = boxes if last else boxes.filter(~large)
        remaining = [F.col(name) for name in keys if name not in pinned]
        distinct = _counted(rows, finished, facts, group, pinned, key, remaining, []).drop("area_low", "area_high")
        found = _pick(distinct, [*group, "cut"], keys).select(
            *group,
            "cut",
            F.struct(*keys).alias("at"),
            F.col("rank").alias("skip"),
            F.col("rows").alias("copies"),
        )
        result = found if result is None else result.unionByName(found)
        if last or not facts["tied"]:
            break
        # What is left has a single value of this key per box: pin it, go on with the next key.
        following = keys[position + 1]
        boxes = _counted(
            rows,
            boxes.filter(large),
            facts,
            group,
            pinned,
            key,
            [F.col(key)],
            [F.min(following).alias("low"), F.max(following).alias("high")],
        ).drop("area_low", "area_high")
        pinned.append(key)
    return result


def exact_percentile(
    df: DataFrame, group: str, value: str, fraction: float, small_box: int = SMALL_BOX
) -> DataFrame:
    """Percentile with linear interpolation, from the two neighbouring order statistics.

    The built-in exact percentile keeps the distinct values of a group in memory; this form
    keeps bin counts only. Nulls, NaN and infinities are left out.
    """
    rows = df.select(group, F.col(value).cast("double").alias("v")).filter(F.abs("v") < float("inf"))
    sizes = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    point = (F.col("rows") - 1) * F.lit(float(fraction))
    wanted, _ = settled(
        sizes.select(
            "*",
            F.inline(
                F.array(
                    F.struct(F.lit("below").alias("cut"), F.floor(point).alias("rank")),
                    F.struct(F.lit("above").alias("cut"), F.ceil(point).alias("rank")),
                )
            ),
        )
    )
    cuts = rank_cuts(rows, [group], ["v"], wanted, small_box)
    below, above = F.col("below"), F.col("above")
    return (
        wanted.join(cuts, [group, "cut"])
        .groupBy(group, "rows")
        .agg(
            F.max(F.when(F.col("cut") == "below", F.col("at.v"))).alias("below"),
            F.max(F.when(F.col("cut") == "above", F.col("at.v"))).alias("above"),
        )
        .select(
            group,
            F.col("rows").alias("n"),
            # The difference of two finite doubles may be none; that of their halves is.
            F.when(F.abs(above / 2 - below / 2) < 2.0**1022, below + (above - below) * (point - F.floor(point)))
            .otherwise((below / 2 + (above / 2 - below / 2) * (point - F.floor(point))) * 2)
            .alias("percentile"),
        )
    )


def seeded_sample(
    df: DataFrame, group: str, identity: Column, size: int, small_box: int = SMALL_BOX
) -> DataFrame:
    """The same random rows on every run: of each group the ``size`` rows with the lowest md5, all of its digits.

    This is the sampling operator itself, so the limit is its result. ``identity`` must name a
    row; the group's threshold is found by :func:`rank_cuts`, so no group is sorted.
    """
    digest = F.md5(identity.cast("binary"))
    marked = df.filter(F.col(group).isNotNull()).withColumns(
        {
            "draw": F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"),
            "draw_rest": F.conv(F.substring(digest, 16, 15), 16, 10).cast("bigint"),
            "draw_last": F.conv(F.substring(digest, 31, 2), 16, 10).cast("bigint"),
        }
    )
    sizes, facts = settled(
        marked.groupBy(group).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("draw").alias("low"),
            F.max("draw").alias("high"),
        )
    )
    wanted = sizes.withColumns({"cut": F.lit("end"), "rank": F.lit(size).cast("bigint")})
    cuts = rank_cuts(marked, [group], ["draw", "draw_rest", "draw_last"], wanted, small_box)
    limits, _ = settled(sizes.select(group).join(cuts.select(group, "at"), group, "left"))
    draw = F.struct("draw", "draw_rest", "draw_last")
    return (
        marked.join(small(limits, facts["rows"]), group)
        .filter(F.col("at").isNull() | (draw < F.col("at")))
        .drop("at", "draw", "draw_rest", "draw_last")
    )
