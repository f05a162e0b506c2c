"""Distances between the value distributions of two slices.

Input everywhere: a group column, ``slice`` and a finite ``value``. All steps aggregate
map-side into bins per group; no group is sorted as a whole, whatever its size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import BINS, equal_width_bin, ks_pvalue, psi_term, share
from tidemark.operators.selection import SMALL_BOX, fine_bin, splitter_number, splitters
from tidemark.operators.slices import CURRENT, HISTORICAL
from tidemark.runtime import cut_lineage, settled, small, stored


def _in(slice_name: str) -> Column:
    return F.count_if(F.col("slice") == slice_name)


def slice_statistics(values: DataFrame, group: str = "feature_name") -> DataFrame:
    """Count, mean, sample variance and sample deviation of each slice of each group.

    One row alone has no variance; it stays null.
    """
    return values.groupBy(group, "slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.var_samp("value").alias("variance"),
        F.stddev_samp("value").alias("std"),
    )


@dataclass
class Binned:
    """Counts that the distances share: one row per group, and one row per group and bin."""

    group: str
    values: DataFrame
    totals: DataFrame
    counts: DataFrame
    groups: int


def bin_values(values: DataFrame, group: str = "feature_name") -> Binned:
    """Range and totals of each group, then the counts of its coarse and fine bins.

    Groups that miss one of the slices are left out: there is nothing to compare.
    """
    totals, facts = settled(
        values.groupBy(group)
        .agg(
            _in(HISTORICAL).alias("n_hist"),
            _in(CURRENT).alias("n_curr"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .filter((F.col("n_hist") > 0) & (F.col("n_curr") > 0))
    )
    counts = cut_lineage(
        values.join(small(totals.select(group, "low", "high"), facts["rows"]), group)
        .groupBy(
            group,
            equal_width_bin(F.col("value"), F.col("low"), F.col("high")).alias("bin"),
            fine_bin(F.col("value"), F.col("low"), F.col("high")).alias("fine"),
        )
        .agg(
            _in(HISTORICAL).alias("hist"),
            _in(CURRENT).alias("curr"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    return Binned(group, values, totals, counts, facts["rows"])


def shared_histogram(binned: Binned) -> DataFrame:
    """Ten equal-width bins on the common range, empty bins included."""
    group = binned.group
    grid = binned.totals.select(
        group,
        "n_hist",
        "n_curr",
        "low",
        "high",
        F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"),
    )
    filled = binned.counts.groupBy(group, "bin").agg(
        F.sum("hist").alias("hist"), F.sum("curr").alias("curr")
    )
    return grid.join(filled, [group, "bin"], "left").withColumns(
        {"hist": F.coalesce("hist", F.lit(0)), "curr": F.coalesce("curr", F.lit(0))}
    )


def population_shift(histogram: DataFrame, group: str = "feature_name") -> DataFrame:
    """PSI and KL(current || historical) from a filled histogram.

    Empty bins get the floor. PSI uses the shares as they are; KL divides both sides by their
    sums first. With a single value on both sides PSI and KL are 0.
    """
    shares = histogram.withColumns(
        {
            "p": share(F.col("curr"), F.col("n_curr")),
            "q": share(F.col("hist"), F.col("n_hist")),
        }
    )
    sums = shares.groupBy(group, "low", "high").agg(
        F.sum(psi_term(F.col("p"), F.col("q"))).alias("psi"),
        F.sum(F.col("p") * F.ln(F.col("p") / F.col("q"))).alias("cross"),
        F.sum("p").alias("p_sum"),
        F.sum("q").alias("q_sum"),
    )
    # sum p/P * ln((p/P) / (q/Q)) = (sum p ln(p/q)) / P + ln(Q / P)
    kl = F.col("cross") / F.col("p_sum") + F.ln(F.col("q_sum") / F.col("p_sum"))
    constant = F.col("low") == F.col("high")
    return sums.select(
        group,
        F.when(constant, 0.0).otherwise(F.col("psi")).alias("psi"),
        F.when(constant, 0.0).otherwise(kl).alias("kl_divergence"),
    )


def _gap() -> Column:
    return F.abs(F.col("hist_upto") / F.col("n_hist") - F.col("curr_upto") / F.col("n_curr"))


def _accumulate(counted: DataFrame, box: list[str], order: str) -> DataFrame:
    """Running counts of both slices inside each box, on top of what lies before the box."""
    running = Window.partitionBy(*box).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumns(
        {
            "hist_upto": F.col("hist_base") + F.sum("hist").over(running),
            "curr_upto": F.col("curr_base") + F.sum("curr").over(running),
        }
    )


def ks_distance(binned: Binned, small_box: int = SMALL_BOX) -> DataFrame:
    """Exact two-sample KS statistic and its asymptotic p-value per group.

    The distance at the bin edges is a lower bound of the answer. Inside a bin the two empirical
    distributions cannot get further apart than from one's start to the other's end, so most
    bins cannot beat the bound and are done. Only the rows of the remaining bins go on, by an equality
    of the bin's number: those of small bins are finished value by value, large ones are divided at the
    splitters of a quantile sketch, which leaves about 1/200 of the rows between two of them, and rows at a splitter are
    a bin of a single value. So the number of rounds follows from the number of rows, whatever the values are.
    """
    group, totals = binned.group, binned.totals
    large = F.col("rows") > small_box
    level = (
        binned.counts.groupBy(group, "fine")
        .agg(
            F.sum("hist").alias("hist"),
            F.sum("curr").alias("curr"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .join(small(totals.select(group, "n_hist", "n_curr"), binned.groups), group)
        .withColumns(
            {"box": F.lit(""), "hist_base": F.lit(0), "curr_base": F.lit(0), "edge": F.lit(0.0)}
        )
    )
    ranges = small(totals.select(group, "low", "high"), binned.groups)
    rows = binned.values.join(ranges, group).select(
        group, "slice", "value", F.lit("").alias("box"), fine_bin(F.col("value"), F.col("low"), F.col("high")).alias("fine")
    )
    reach = F.greatest(
        F.col("hist_upto") / F.col("n_hist")
        - (F.col("curr_upto") - F.col("curr")) / F.col("n_curr"),
        F.col("curr_upto") / F.col("n_curr")
        - (F.col("hist_upto") - F.col("hist")) / F.col("n_hist"),
    )
    found: list[DataFrame] = []
    while True:
        whole_group = Window.partitionBy(group)
        level, facts = settled(
            _accumulate(level, [group, "box"], "fine")
            .withColumn("edge", F.max(F.greatest(F.col("edge"), _gap())).over(whole_group))
            .withColumn("rows", F.col("hist") + F.col("curr"))
            .withColumn("open", (F.col("low") < F.col("high")) & (reach > F.col("edge"))),
            finish=F.count_if(F.col("open") & (F.col("rows") <= small_box)),
            divide=F.count_if(F.col("open") & (F.col("rows") > small_box)),
        )
        found.append(level.select(group, "edge"))
        boxes = level.filter("open").select(
            group,
            "box",
            "fine",
            "n_hist",
            "n_curr",
            "edge",
            "rows",
            (F.col("hist_upto") - F.col("hist")).alias("hist_base"),
            (F.col("curr_upto") - F.col("curr")).alias("curr_base"),
        )
        carried = [group, "box", "n_hist", "n_curr", "hist_base", "curr_base", "edge"]
        both = [_in(HISTORICAL).alias("hist"), _in(CURRENT).alias("curr")]
        inner = F.concat_ws("/", "box", F.col("fine").cast("string")).alias("box")
        if facts["finish"]:
            counted = (
                rows.join(small(boxes.filter(~large), facts["finish"]), [group, "box", "fine"])
                .select(*[name for name in carried if name != "box"], inner, "slice", "value")
                .groupBy(*carried, "value")
                .agg(*both)
            )
            closed = _accumulate(counted, [group, "box"], "value")
            found.append(closed.select(group, _gap().alias("edge")))
        if not facts["divide"]:
            break
        held = rows.join(small(boxes.filter(large), facts["divide"]), [group, "box", "fine"]).select(
            *[name for name in carried if name != "box"], inner, "slice", "value"
        )
        held = stored(held, "open-bins")
        grids, grid_facts = settled(held.groupBy(group, "box").agg(splitters("value").alias("grid")))
        numbered = held.join(small(grids, grid_facts["rows"]), [group, "box"])
        rows = stored(numbered.withColumn("fine", splitter_number(F.col("value"), F.col("grid"))).drop("grid"), "open-bins")
        level = rows.groupBy(*carried, "fine").agg(*both, F.min("value").alias("low"), F.max("value").alias("high"))
        rows = rows.select(group, "slice", "value", "box", "fine")
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    distance = edges.groupBy(group).agg(F.max("edge").alias("ks_stat"))
    return small(totals, binned.groups).join(distance, group).select(
        group,
        "n_hist",
        "n_curr",
        "ks_stat",
        ks_pvalue(F.col("ks_stat"), F.col("n_hist"), F.col("n_curr")).alias("ks_p_value"),
    )
