"""Drift per feature, per model, over categories, against a baseline and over labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import (
    BINS,
    drift_status,
    equal_width_bin,
    finite_double,
    psi_term,
    share,
)
from tidemark.operators.distribution import (
    bin_values,
    ks_distance,
    population_shift,
    shared_histogram,
)
from tidemark.operators.selection import SMALL_BOX
from tidemark.operators.slices import CURRENT, HISTORICAL, numeric_values
from tidemark.runtime import join_side, settled, small, stored


def feature_drift(
    slices: DataFrame,
    group: str = "feature_name",
    value: str = "value",
    small_box: int = SMALL_BOX,
) -> DataFrame:
    """KS, PSI, KL and status of every group that has rows in both slices."""
    values = stored(numeric_values(slices, group, value), "slices")
    binned = bin_values(values, group)
    shift = population_shift(shared_histogram(binned), group)
    return (
        ks_distance(binned, small_box)
        .join(shift, group)
        .withColumn(
            "status", drift_status(F.col("psi"), F.col("ks_p_value"), F.col("ks_stat"))
        )
    )


def category_counts(slices: DataFrame, group: str, category: Column) -> DataFrame:
    """Rows per slice of each category of each group."""
    return slices.groupBy(group, category.alias("category")).agg(
        F.count_if(F.col("slice") == HISTORICAL).alias("hist"),
        F.count_if(F.col("slice") == CURRENT).alias("curr"),
    )


def _with_totals(counts: DataFrame, group: str) -> DataFrame:
    kept, _ = settled(counts)
    totals = kept.groupBy(group).agg(F.sum("hist").alias("n_hist"), F.sum("curr").alias("n_curr"))
    return kept.join(
        join_side(totals.filter((F.col("n_hist") > 0) & (F.col("n_curr") > 0))), group
    )


def categorical_psi(counts: DataFrame, group: str) -> DataFrame:
    """PSI with categories in place of bins; a category missing on one side gets the floor."""
    p = share(F.col("curr"), F.col("n_curr"))
    q = share(F.col("hist"), F.col("n_hist"))
    return _with_totals(counts, group).groupBy(group).agg(
        F.count(F.lit(1)).alias("categories"), F.sum(psi_term(p, q)).alias("psi")
    )


def chi_square(counts: DataFrame, group: str) -> DataFrame:
    """Chi-square statistic of the slice-by-category table and its degrees of freedom."""
    both = F.col("hist") + F.col("curr")
    everything = F.col("n_hist") + F.col("n_curr")

    def cell(seen: str, total: str) -> Column:
        expected = both * F.col(total) / everything
        return (F.col(seen) - expected) * (F.col(seen) - expected) / expected

    return _with_totals(counts, group).groupBy(group).agg(
        F.sum(cell("hist", "n_hist") + cell("curr", "n_curr")).alias("chi_square"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
    )


def baseline_statistics(
    rows: DataFrame, group: str = "feature_name", value: str = "value"
) -> DataFrame:
    """What a training job saves beside its model: range, moments and ten bin counts.

    ``bins`` is an array of the ten counts, so the result is one row per group.
    """
    clean = rows.select(group, finite_double(F.col(value)).alias("value")).filter(
        F.col("value").isNotNull()
    )
    ranges, facts = settled(
        clean.groupBy(group).agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    binned = clean.join(small(ranges.select(group, "low", "high"), facts["rows"]), group).select(
        group, equal_width_bin(F.col("value"), F.col("low"), F.col("high")).alias("bin")
    )
    counts = binned.groupBy(group).agg(
        F.array(*[F.count_if(F.col("bin") == i) for i in range(BINS)]).alias("bins")
    )
    return ranges.join(counts, group)


def baseline_drift(
    baseline: DataFrame,
    live: DataFrame,
    group: str = "feature_name",
    value: str = "value",
) -> DataFrame:
    """PSI and KL of live rows against a stored baseline, in the baseline's bins.

    Live values below the lowest or above the highest edge count in the first or last bin.
    """
    known = join_side(baseline.select(group, "n", "low", "high", "bins"))
    clean = live.select(group, finite_double(F.col(value)).alias("value")).filter(
        F.col("value").isNotNull()
    )
    placed = clean.join(known.select(group, "low", "high"), group).select(
        group, equal_width_bin(F.col("value"), F.col("low"), F.col("high")).alias("bin")
    )
    current = placed.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_curr"),
        F.array(*[F.count_if(F.col("bin") == i) for i in range(BINS)]).alias("live_bins"),
    )
    histogram = known.join(current, group).select(
        group,
        "low",
        "high",
        F.col("n").alias("n_hist"),
        "n_curr",
        F.inline(
            F.arrays_zip(F.col("bins").alias("hist"), F.col("live_bins").alias("curr"))
        ),
    )
    return population_shift(histogram, group)


def metrics_long(metrics: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row per key and metric, the form metric stores take."""
    return metrics.unpivot(keys, names, "metric", "value")
