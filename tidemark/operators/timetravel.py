"""Latest values and point-in-time joins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import composite_key, online_value
from tidemark.operators.scans import dealt, of_last_key, running_max
from tidemark.runtime import BROADCAST_ROWS, settled, stored

LOG_KEYS = ["entity_id", "feature_name"]


# Both clocks in one number: event time in microseconds times _SCALE, plus knowledge time.
_SCALE = "10000000000000000000BD"
# Stands for a missing knowledge time: before every real one.
_UNKNOWN = -(10**17)


def _newest_per(log: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key by event time, then by knowledge time.

    The maximum of a struct would need a sort before each aggregation step. A decimal can be
    updated in place, so this aggregates by hash and combines map-side.
    """
    event = "cast(unix_micros(event_timestamp) as decimal(18,0))"
    known = f"cast(coalesce(unix_micros(created_at), {_UNKNOWN}) as decimal(18,0))"
    picked = (
        log.select(
            *keys, "value", "event_timestamp", F.expr(f"{event} * {_SCALE} + {known}").alias("order")
        )
        .groupBy(*keys)
        .agg(
            F.max_by("value", "order").alias("value"),
            F.max("event_timestamp").alias("event_timestamp"),
            F.max("order").alias("order"),
        )
    )
    created = F.expr(f"cast(order - {event} * {_SCALE} as bigint)")
    return picked.select(
        *keys,
        "value",
        "event_timestamp",
        F.when(created != _UNKNOWN, F.timestamp_micros(created)).alias("created_at"),
    )


def latest_values(log: DataFrame, keys: list[str] = LOG_KEYS) -> DataFrame:
    """Newest value per key by event time, then by knowledge time.

    A late arrival of an older event changes nothing. One aggregation with map-side combine, so
    a key with very many rows sends one row per task.
    """
    return _newest_per(log.filter(F.col("event_timestamp").isNotNull()), keys)


def online_entries(latest: DataFrame) -> DataFrame:
    """Key and JSON value of every online entry."""
    return latest.select(
        composite_key(F.col("entity_id"), F.col("feature_name")).alias("key"),
        online_value(F.col("value"), F.col("event_timestamp")).alias("value"),
    )


def hydrate(requests: DataFrame, latest: DataFrame) -> DataFrame:
    """Requests ``(request_id, entity_id, feature_names)`` with one row per wanted feature.

    Unknown entities and features keep their row with a null value.
    """
    wanted = requests.select(
        "request_id", "entity_id", F.posexplode("feature_names").alias("index", "feature_name")
    )
    return wanted.join(
        latest.select(*LOG_KEYS, "value", "event_timestamp"), LOG_KEYS, "left"
    )


def _visible_from(bitemporal: bool) -> Column:
    """First moment at which a row may be used.

    With both clocks ``event_timestamp <= t and created_at <= t`` is the same as
    ``greatest(...) <= t``, which turns the two-sided condition into one ordered axis.
    """
    if bitemporal:
        known = F.col("created_at").isNotNull() & F.col("event_timestamp").isNotNull()
        return F.when(known, F.greatest("event_timestamp", "created_at"))
    return F.col("event_timestamp")


def _usable(log: DataFrame, keys: list[str], labels: DataFrame, label_time: str, bitemporal: bool, max_age: Column | None) -> DataFrame:
    """Rows of the log that some label may see, with the moment from which they are ``visible``."""
    newest, oldest = (labels.select(f(label_time)).scalar() for f in (F.max, F.min))
    rows = (
        log.dropna(subset=keys)  # a null key matches nothing
        .withColumn("visible", _visible_from(bitemporal))
        .filter((F.col("event_timestamp") <= newest) & (F.col("visible") <= newest))
    )
    if max_age is not None:
        rows = rows.filter(F.col("event_timestamp") >= oldest - max_age)
    # Keys that no label asks for need not be shuffled, if the asked ones are few enough to be sent around.
    asked, facts = settled(labels.select(*keys).dropna().distinct())
    return rows.join(F.broadcast(asked), keys, "left_semi") if facts["rows"] <= BROADCAST_ROWS else rows


def pit_join(
    labels: DataFrame,
    log: DataFrame,
    keys: list[str] = LOG_KEYS,
    label_time: str = "label_time",
    bitemporal: bool = False,
    max_age: Column | None = None,
) -> DataFrame:
    """For each label row the newest feature row that was visible at its time; never a later one.

    Labels without a match keep null values, those with a null key or time among them. ``bitemporal``
    also asks that the row was already known (``created_at``). ``max_age`` (an interval) drops matches
    that are too old. Rows that agree in both clocks go by the larger value.

    The distinct (key, time) of the labels are looked up by a running maximum of (event time,
    knowledge time, value), see :mod:`tidemark.operators.scans`, and joined back; labels may have columns of any type.
    """
    usable = _usable(log, keys, labels, label_time, bitemporal, max_age)
    state = F.struct("event_timestamp", "created_at", "value")
    points = usable.select(*keys, F.col("visible").alias("at"), state.alias("state"))
    found = running_max(points, labels.select(*keys, F.col(label_time).alias("at")), keys)
    asked = found.select(*[F.col(key).alias(f"asked_{i}") for i, key in enumerate(keys)], F.col("at").alias("asked_at"), F.col("state").alias("match"))
    same = [labels[key] == asked[f"asked_{i}"] for i, key in enumerate(keys)] + [labels[label_time] == asked["asked_at"]]
    fresh = F.lit(True)
    if max_age is not None:
        fresh = asked["match"]["event_timestamp"] >= labels[label_time] - max_age
    names = ("value", "event_timestamp", "created_at")
    return labels.join(asked, same, "left").select(
        *[labels[name] for name in labels.columns], *[F.when(fresh, asked["match"][name]).alias(name) for name in names]
    )


# Cells of labels times features that one task fills.
WIDE_CELLS = 20_000_000


def training_set(
    labels: DataFrame,
    log: DataFrame,
    features: list[str],
    key: str = "entity_id",
    label_time: str = "label_time",
    bitemporal: bool = False,
) -> DataFrame:
    """Label rows with one point-in-time column per feature.

    Rows of the log go through the shuffle as they are, with the number of their feature; labels are neither
    multiplied by the features nor pivoted back. The state of an entity, feature number to newest
    row, is kept while its rows are passed in order, in Arrow batches of a range of (entity, moment);
    what earlier ranges know of a range's first entity comes as further rows. Null keys match nothing.
    """
    numbers = F.create_map(*[x for i, name in enumerate(features) for x in (F.lit(name), F.lit(i))])
    usable = _usable(log.filter(F.col("feature_name").isin(features)), [key], labels, label_time, bitemporal, None)
    rows = usable.select(
        F.col(key).alias("k"),
        F.unix_micros("visible").alias("at"),
        F.lit(0).alias("side"),
        numbers[F.col("feature_name")].alias("feature"),
        F.unix_micros("event_timestamp").alias("event"),
        F.coalesce(F.unix_micros("created_at"), F.lit(_UNKNOWN)).alias("known"),
        F.coalesce("value", F.lit(0.0)).alias("value"),
        F.col("value").isNotNull().cast("int").alias("has"),
    )
    asks = stored(labels.select(F.col(key).alias("k"), F.unix_micros(label_time).alias("at")).dropna().distinct(), "asks")
    axis = rows.unionByName(asks.withColumn("side", F.lit(1)), allowMissingColumns=True)
    enough = -(-asks.count() * len(features) // WIDE_CELLS)
    spark = labels.sparkSession
    ranges, ends = dealt(axis, ["k"], ["at", "side", "feature", "event", "known", "has", "value"], max(enough, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    state = F.struct("event", "known", "has", "value")
    tails = stored(
        of_last_key(ranges, ends, ["k"]).filter("side = 0").groupBy("part", "k", "feature").agg(F.max(state).alias("state")), "tails"
    )
    # At most ranges times features rows, as tails are.
    heads = ends.select("part", F.col("first.k").alias("k")).join(tails.select("k", "feature").distinct(), "k")
    chain = heads.withColumn("tail", F.lit(0)).unionByName(tails.withColumn("tail", F.lit(1)), allowMissingColumns=True)
    earlier = Window.partitionBy("k", "feature").orderBy("part", "tail").rowsBetween(Window.unboundedPreceding, -1)
    carried = chain.withColumn("state", F.max("state").over(earlier)).filter("tail = 0 and state is not null")
    carried = carried.select("part", "k", F.lit(_UNKNOWN * 10).alias("at"), F.lit(-1).alias("side"), "feature", "state.*")
    filled = ranges.unionByName(carried).groupBy("part").applyInPandas(
        _filler(len(features)), "k string, at long, present array<tinyint>, found array<double>"
    )
    asked = filled.select(F.col("k").alias("asked_key"), "at", "present", "found")
    same = (labels[key] == asked["asked_key"]) & (F.unix_micros(labels[label_time]) == asked["at"])
    return labels.join(asked, same, "left").select(
        *[labels[name] for name in labels.columns],
        # pandas hands NaN back as null.
        *[F.when(asked["present"][i] == 1, F.coalesce(asked["found"][i], F.lit(float("nan")))).alias(name) for i, name in enumerate(features)],
    )


def _filler(features: int):
    """For each ask of a range the newest value of every feature at its moment."""

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        codes, names = pd.factorize(rows["k"], sort=True)
        at, side = rows["at"].to_numpy(), rows["side"].to_numpy()
        order = np.lexsort((side, at, codes))
        codes, side = codes[order], side[order]
        is_ask = side == 1
        asks = np.flatnonzero(is_ask)
        present = np.zeros((len(asks), features), np.int8)
        found = np.zeros((len(asks), features))
        event, known, has, value, feature = (rows[name].to_numpy()[order] for name in ("event", "known", "has", "value", "feature"))
        # Newest is by event time, knowledge time and value; a null value comes first.
        ranked = np.lexsort((value, has, known, event))
        rank = np.empty(len(order), np.int64)
        rank[ranked] = np.arange(len(order))
        for number in np.unique(feature[~is_ask]).astype(int):
            places = np.flatnonzero(~is_ask & (feature == number))
            # Keys ascend, so the running maximum of (key, rank) starts anew with each key.
            best = np.maximum.accumulate(codes[places] * len(order) + rank[places])
            before = np.searchsorted(places, asks) - 1
            newest = best[np.maximum(before, 0)]
            row = ranked[newest % len(order)]
            present[:, number] = (before >= 0) & (newest // len(order) == codes[asks]) & (has[row] == 1)
            found[:, number] = value[row]
        return pd.DataFrame({"k": names[codes[asks]], "at": at[order][asks], "present": pd.Series(list(present), dtype=object), "found": pd.Series(list(found), dtype=object)})

    return fill


def training_window(
    log: DataFrame, days: int = 30, as_of: Column | None = None, time: str = "event_timestamp"
) -> DataFrame:
    """Rows from ``as_of - days`` on; the default ``as_of`` is the newest event."""
    moment = as_of if as_of is not None else log.select(F.max(time)).scalar()
    return log.filter(F.col(time) >= moment - F.make_dt_interval(F.lit(days)))
