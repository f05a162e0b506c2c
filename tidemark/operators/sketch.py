"""Mergeable quantile sketches of a value column and what is read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import finite_double
from tidemark.operators.features import trailing_interval
from tidemark.operators.slices import CURRENT, HISTORICAL

SKETCH_SIZE = 400
# Points at which two sketches are compared.
GRID = 200


def sketch_by(df: DataFrame, keys: list[str], value: str = "value", size: int = SKETCH_SIZE) -> DataFrame:
    """KLL sketch per key; nulls, NaN and texts are passed over. Partial sketches merge map-side."""
    return df.groupBy(*keys).agg(
        F.kll_sketch_agg_double(finite_double(F.col(value)), F.lit(size)).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, keys: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """Combine stored sketches, for example hourly ones into daily ones."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    )


def read_quantiles(sketches: DataFrame, keys: list[str], ranks: list[float]) -> DataFrame:
    return sketches.select(
        *keys,
        F.kll_sketch_get_n_double("sketch").alias("n"),
        *[
            F.kll_sketch_get_quantile_double("sketch", F.lit(rank)).alias(f"q{round(rank * 100)}")
            for rank in ranks
        ],
    )


def analyze_interval(
    df: DataFrame,
    column: str,
    interval: Column,
    as_of: Column | None = None,
    time: str = "event_timestamp",
) -> DataFrame:
    """One row summarising a column over the trailing interval, with the JSON form of it.

    Each value counts as a centroid of weight one, so the centroid count equals the row count.
    """
    recent = trailing_interval(df, interval, as_of, time).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean")
    )
    answer = recent.select(
        F.lit("success").alias("status"),
        F.col("n").alias("analyzed_centroids"),
        F.col("n").alias("total_weight"),
        F.coalesce("mean", F.lit(0.0)).alias("calculated_mean"),
        F.lit(False).alias("drift_detected"),
        F.lit("Analysis complete").alias("message"),
    )
    return answer.withColumn("result_json", F.to_json(F.struct(*answer.columns)))


def analyze_table(spark, interval_sql: str, table: str, column: str) -> DataFrame:
    """The same for a table and column given by name; both names are bound as identifiers.

    The interval is a value too (``"36 HOURS"``), never a piece of SQL; a text that is none raises.
    """
    width = F.lit(interval_sql).cast("interval")
    if spark.range(1).select(width.isNull()).first()[0]:
        raise ValueError(f"not an interval: {interval_sql}")
    named = spark.sql(
        "SELECT event_timestamp, IDENTIFIER(:column) AS analyzed FROM IDENTIFIER(:table)",
        args={"column": column, "table": table},
    )
    return analyze_interval(named, "analyzed", width)


def sketch_distance(
    slices: DataFrame, group: str = "feature_name", value: str = "value", size: int = SKETCH_SIZE
) -> DataFrame:
    """Approximate KS distance of two slices from their sketches alone.

    Each sketch is read at the same evenly spaced ranks, which gives an evenly weighted sample of
    either slice; the distance is taken between these two samples. Only two small binary values
    per group leave the aggregation.
    """
    number = finite_double(F.col(value))
    both = slices.groupBy(group).agg(
        F.kll_sketch_agg_double(F.when(F.col("slice") == HISTORICAL, number), F.lit(size)).alias("hist"),
        F.kll_sketch_agg_double(F.when(F.col("slice") == CURRENT, number), F.lit(size)).alias("curr"),
    )
    sized = both.withColumns(
        {
            "n_hist": F.kll_sketch_get_n_double("hist"),
            "n_curr": F.kll_sketch_get_n_double("curr"),
        }
    ).filter((F.col("n_hist") > 0) & (F.col("n_curr") > 0))
    ranks = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    read = sized.select(
        group,
        "n_hist",
        "n_curr",
        F.kll_sketch_get_quantile_double("hist", ranks).alias("h"),
        F.kll_sketch_get_quantile_double("curr", ranks).alias("c"),
    )

    def at_most(sample: str, point: Column) -> Column:
        return F.size(F.filter(sample, lambda q: q <= point)) / GRID

    gaps = F.transform(
        F.array_distinct(F.concat("h", "c")),
        lambda point: F.abs(at_most("h", point) - at_most("c", point)),
    )
    return read.select(group, "n_hist", "n_curr", F.array_max(gaps).alias("sketch_ks"))
