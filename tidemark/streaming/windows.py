"""Hourly windows kept by batches, with a branch for rows that come too late.

The watermark is the newest event time of the batches before, less the delay, as Structured Streaming
has it. It is stored with the version of the windows it belongs to, so a batch that is tried again
meets the same one. A row whose window ended at or before the watermark is late: it is counted in no
window, lies in the offline log with a mark, and :func:`add_late_rows` adds it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.keyed import KeyedStore
from tidemark.streaming.feeds import INGEST_TRIGGER, paced, replace_batch

STATE = "window_start timestamp, feature_name string, n long, mean double, m2 double, low double, high double, bins array<long>"
WATERMARK, LATE_UPTO = "watermark_micros", "late_upto"


def window_start(time: str, width: str) -> Column:
    return F.window(time, width)["start"]


def window_states(events: DataFrame, edges: list[float], time: str = "event_timestamp", width: str = "1 hour") -> DataFrame:
    """Mergeable state per window and feature: count, mean, squared deviations, range, and counts between the edges."""
    place = F.lit(0)
    for edge in edges:
        place = place + (F.col("value") >= F.lit(float(edge))).cast("int")
    return events.groupBy(window_start(time, width).alias("window_start"), "feature_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.array(*[F.count_if(F.col("value").isNotNull() & (place == i)) for i in range(len(edges) + 1)]).alias("bins"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One state per window and feature. A key has one row per run at most, so its list is short."""
    parts = F.array_sort(F.collect_list(F.struct("n", "mean", "m2", "low", "high", "bins")))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        both = F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
            F.least(a["low"], b["low"]).alias("low"),
            F.greatest(a["high"], b["high"]).alias("high"),
            F.zip_with(a["bins"], b["bins"], lambda x, y: x + y).alias("bins"),
        )
        # Windows with nothing but null values have no mean.
        return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)

    grouped = states.groupBy("window_start", "feature_name").agg(parts.alias("parts"))
    total = F.aggregate(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), F.element_at("parts", 1), add)
    return grouped.select("window_start", "feature_name", total.alias("total")).select("window_start", "feature_name", "total.*")


def window_store(spark: SparkSession, path: str) -> KeyedStore:
    return KeyedStore(spark, path.rstrip("/"), STATE, ("window_start", "feature_name"), merged_states)


def statistics(states: DataFrame) -> DataFrame:
    """Windows with the columns of a batch aggregate: sample variance and deviation are null below two values."""
    variance = F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1))
    return states.select(
        "window_start", "feature_name", "n", "mean", variance.alias("variance"), F.sqrt(variance).alias("std"), "low", "high", "bins"
    )


def windowed_write(
    events: DataFrame,
    offline: str,
    windows: str,
    checkpoint: str,
    delay: str,
    edges: list[float],
    time: str = "event_timestamp",
    width: str = "1 hour",
    trigger: str | None = INGEST_TRIGGER,
) -> StreamingQuery:
    """Write each batch to the offline log, late rows marked, and merge the others into the windows.

    Rows without an event time belong to no window; they lie in the log and are not late.
    """
    store = window_store(events.sparkSession, windows)

    def write(batch: DataFrame, batch_id: int) -> None:
        pointer = store.pointer()
        if batch_id <= pointer.batch:
            return  # Both were written before the version was published.
        seen = pointer.facts.get(WATERMARK)
        ends = F.unix_micros(F.window(time, width)["end"])
        late = F.lit(False) if seen is None else F.coalesce(ends <= F.lit(seen), F.lit(False))
        batch = batch.withColumn("late", late).persist()
        try:
            replace_batch(batch, offline, batch_id)
            newest = batch.agg(F.unix_micros(F.max(time) - F.expr(f"INTERVAL {delay}"))).first()[0]
            marks = [mark for mark in (seen, newest) if mark is not None]
            on_time = batch.filter(~F.col("late") & F.col(time).isNotNull())
            store.apply(window_states(on_time, edges, time, width), batch_id, **({WATERMARK: max(marks)} if marks else {}))
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return paced(writer, trigger).start()


def add_late_rows(
    spark: SparkSession, offline: str, windows: str, edges: list[float], time: str = "event_timestamp", width: str = "1 hour"
) -> None:
    """Backfill: add the late rows of the batches written so far to their windows, each of them once.

    Which batches were added is published together with the windows, so a second run, or one after a
    failure, adds nothing twice. Not to be run while the stream writes.
    """
    store = window_store(spark, windows)
    pointer = store.pointer()
    done = pointer.facts.get(LATE_UPTO, -1)
    if pointer.batch <= done:
        return
    rows = spark.read.parquet(offline).filter(F.col("batch").between(done + 1, pointer.batch) & F.col("late"))
    store.amend(window_states(rows, edges, time, width), **{LATE_UPTO: pointer.batch})
