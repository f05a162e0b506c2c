"""The historical and the current slice of every feature."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import finite_double
from tidemark.operators.selection import SMALL_BOX, rank_cuts
from tidemark.runtime import settled, small

HISTORICAL = "historical"
CURRENT = "current"
# Position of both slices in the time-ordered rows of a feature.
HISTORICAL_SPAN = (0.50, 0.70)
CURRENT_FROM = 0.95

_KEYS = ["time_key", "known_key", "row_key"]


def _offset(rows: Column, fraction: float) -> Column:
    """Floor of a fraction of the row count, in double arithmetic."""
    return F.floor(rows * F.lit(float(fraction)))


def _marked(log: DataFrame, group: str, time: str, known: str) -> DataFrame:
    """The log with its three order keys; rows of no group or time have no place."""
    return log.filter(F.col(group).isNotNull() & F.col(time).isNotNull()).withColumns(
        {
            "time_key": F.unix_micros(time),
            "known_key": F.coalesce(F.unix_micros(known), F.lit(-(2**62))),
            "row_key": F.shiftrightunsigned(F.xxhash64(*log.columns), 1),
        }
    )


def _placed(
    marked: DataFrame, group: str, time: str, ranks: dict[str, Column], small_box: int
) -> tuple[DataFrame, Callable[[str], Column]]:
    """Rows from the first of the ranks on, and a test whether a row comes before a rank.

    ``ranks`` are zero-based positions in the group's order, as expressions over ``rows``, its
    size. Each row is compared with the keys found at these positions by :func:`rank_cuts`; the
    log itself is neither sorted nor shuffled.
    """
    sizes = marked.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("time_key").alias("low"),
        F.max("time_key").alias("high"),
    )
    positions = [
        F.struct(F.lit(label).alias("cut"), rank.cast("bigint").alias("rank"))
        for label, rank in ranks.items()
    ]
    wanted = sizes.select(group, "rows", "low", "high", F.inline(F.array(*positions)))
    cuts = rank_cuts(marked, [group], _KEYS, wanted, small_box)
    labels = [F.col(label) for label in ranks]
    ends, facts = settled(
        cuts.groupBy(group).agg(
            *[
                F.max(F.when(F.col("cut") == label, F.struct("at", "skip", "copies"))).alias(label)
                for label in ranks
            ]
        ),
        oldest=F.min(F.least(*[label["at"]["time_key"] for label in labels])),
        copies=F.max(F.greatest(*[label["copies"] for label in labels])),
    )
    if facts["oldest"] is not None:
        marked = marked.filter(F.col(time) >= F.timestamp_micros(F.lit(facts["oldest"])))
    held = marked.join(small(ends, facts["rows"]), group)
    place = F.struct(*_KEYS)
    copy = F.lit(1)
    if (facts["copies"] or 1) > 1:
        # A rank falls inside a run of identical rows: number these copies, and only these.
        repeated = F.lit(False)
        for label in ranks:
            cut = F.col(label)
            repeated = repeated | F.coalesce(
                (place == cut["at"]) & (cut["copies"] > 1), F.lit(False)
            )
        numbered = Window.partitionBy(group, *_KEYS).orderBy(*_KEYS)
        held = held.filter(repeated).withColumn("copy", F.row_number().over(numbered)).unionByName(
            held.filter(~repeated).withColumn("copy", F.lit(1))
        )
        copy = F.col("copy")

    def before(label: str) -> Column:
        cut = F.col(label)
        return F.coalesce(
            (place < cut["at"]) | ((place == cut["at"]) & (copy <= cut["skip"])), F.lit(True)
        )

    return held, before


def positional_slices(
    log: DataFrame,
    group: str = "feature_name",
    time: str = "event_timestamp",
    known: str = "created_at",
    small_box: int = SMALL_BOX,
) -> DataFrame:
    """Rows of both slices by position in event-time order, with a ``slice`` column.

    Historical is the part from 50 % to 70 % of a feature's rows, current the last 5 %. Rows of
    one event time are ordered by knowledge time, then by a hash of the row. The slices are whole.
    """
    rows = F.col("rows")
    first, end = _offset(rows, HISTORICAL_SPAN[0]), _offset(rows, HISTORICAL_SPAN[1])
    start, stop = _offset(rows, CURRENT_FROM), rows
    ranks = {"h_from": first, "h_to": end, "c_from": start, "c_to": stop}
    held, before = _placed(_marked(log, group, time, known), group, time, ranks, small_box)
    name = F.when(~before("h_from") & before("h_to"), HISTORICAL).when(
        ~before("c_from") & before("c_to"), CURRENT
    )
    sliced = held.withColumn("slice", name).filter(F.col("slice").isNotNull())
    return sliced.select(*log.columns, "slice")


def events_in_order(
    log: DataFrame,
    feature: str,
    offset: int,
    limit: int,
    time: str = "event_timestamp",
    known: str = "created_at",
    small_box: int = SMALL_BOX,
) -> DataFrame:
    """One page of a feature's rows in time order.

    Only the page is sorted; what lies before the offset is counted, not carried along.
    """
    own = log.filter(F.col("feature_name") == feature)
    ranks = {"from": F.lit(offset), "to": F.lit(offset + limit)}
    marked = _marked(own, "feature_name", time, known)
    held, before = _placed(marked, "feature_name", time, ranks, small_box)
    page = held.filter(F.col("from").isNotNull() & ~before("from") & before("to"))
    return page.orderBy(*_KEYS).select(*log.columns)


def period_slices(
    log: DataFrame,
    as_of: Column,
    days: int = 7,
    gap_days: int = 7,
    time: str = "event_timestamp",
) -> DataFrame:
    """The last ``days`` before ``as_of`` against a period of the same length ``gap_days`` older.

    Pure range filters on event time: nothing is ranked, and partitions outside both periods
    are pruned.
    """
    width, gap = F.make_dt_interval(F.lit(days)), F.make_dt_interval(F.lit(gap_days))
    moment = F.col(time)
    current = (moment > as_of - width) & (moment <= as_of)
    older = (moment > as_of - width - gap) & (moment <= as_of - gap)
    return (
        log.filter(current | older)
        .withColumn("slice", F.when(current, CURRENT).otherwise(HISTORICAL))
    )


def numeric_values(slices: DataFrame, group: str = "feature_name", value: str = "value") -> DataFrame:
    """Group, slice and finite value; rows without a number are dropped after slicing."""
    return slices.select(
        group, "slice", finite_double(F.col(value)).alias("value")
    ).filter(F.col("value").isNotNull())
