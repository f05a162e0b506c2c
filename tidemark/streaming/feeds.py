"""Structured Streaming jobs: ingest, alerts, windows and joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.alerts import COOLDOWN_SECONDS, THRESHOLD
from tidemark.operators.timetravel import LOG_KEYS, latest_values
from tidemark.sinks.keyed import KeyedStore
from tidemark.sinks.writers import route_envelopes
from tidemark.sources.messages import dead_letters, good_events, parse_messages

# Fixed value: pace of ingest.
INGEST_TRIGGER = "2 seconds"


def paced(writer, trigger: str | None):
    """A fixed pace, or everything that is there and then stop."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def batch_bound(format: str, rows: int | None = None, files: int | None = None, size: str | None = None) -> dict[str, str]:
    """Source options that bound a micro-batch, in a unit that the source counts in.

    Message sources count rows, file sources files or bytes (``"64m"``); a bound in another unit raises.
    """
    if format == "kafka":
        if rows is None or files is not None or size is not None:
            raise ValueError("a message source is bounded by rows")
        return {"maxOffsetsPerTrigger": str(rows)}
    if rows is not None or (files is None) == (size is None):
        raise ValueError("a file source is bounded either by files or by size")
    return {"maxFilesPerTrigger": str(files)} if size is None else {"maxBytesPerTrigger": size}


def replace_batch(rows: DataFrame, path: str, batch_id: int, by: tuple[str, ...] = ()) -> None:
    """Write a micro-batch under its own number, replacing an earlier attempt of the same one."""
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path.rstrip('/')}/batch={batch_id}")


def online_store(spark: SparkSession, path: str) -> KeyedStore:
    """Newest value per entity and feature, merged batch by batch."""
    schema = "entity_id string, feature_name string, value double, event_timestamp timestamp, created_at timestamp"
    return KeyedStore(spark, path.rstrip("/"), schema, tuple(LOG_KEYS), latest_values)


def dual_write(
    messages: DataFrame, offline: str, online: str, dead: str, checkpoint: str, trigger: str | None = INGEST_TRIGGER
) -> StreamingQuery:
    """Parse messages once per batch, then write online, offline and dead letters.

    Online first, as readers of fresh values wait for it. The offsets are committed after all
    three; a batch that is replayed overwrites its own files, and the online store passes it over.
    Offline rows are divided by date inside their batch. :func:`online_view` reads the online store.
    """
    parsed = parse_messages(messages)
    store = online_store(messages.sparkSession, online)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = good_events(batch)
            store.apply(good, batch_id)
            replace_batch(good.withColumn("event_date", F.to_date("event_timestamp")), offline, batch_id, ("event_date",))
            replace_batch(dead_letters(batch), dead, batch_id)
        finally:
            batch.unpersist()

    writer = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return paced(writer, trigger).start()


def demux(
    envelopes: DataFrame, schemas: dict[str, T.StructType], path: str, checkpoint: str, trigger: str | None = INGEST_TRIGGER
) -> StreamingQuery:
    """Write the rows of each table, and what is unusable, under the number of their batch.

    One job per batch for any number of tables. A batch that is tried again overwrites its own folder, so nothing is
    doubled. Read with :func:`tidemark.sinks.writers.routed` and ``refused``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        route_envelopes(batch, schemas, f"{path.rstrip('/')}/batch={batch_id}", mode="overwrite")

    writer = envelopes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return paced(writer, trigger).start()


def online_view(spark: SparkSession, online: str) -> DataFrame:
    """Newest value per key over all batches: a whole version, at a cost that does not grow with their number."""
    return online_store(spark, online).read()


def without_replays(events: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """One row per event of an at-least-once source, for replays within the delay.

    Rows later than the watermark are not seen here; :func:`windowed_write` keeps and marks them.
    """
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def hourly_statistics(events: DataFrame, time: str = "event_timestamp", width: str = "1 hour", delay: str | None = None) -> DataFrame:
    """Tumbling windows with the count, moments and range of each feature.

    Works on tables and streams; a stream needs ``delay``, how late an event may be.
    """
    if delay is not None:
        events = events.withWatermark(time, delay)
    return events.groupBy(F.window(time, width).alias("window"), "feature_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.var_samp("value").alias("variance"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def window_histogram(events: DataFrame, edges: list[float], time: str = "event_timestamp", width: str = "1 hour") -> DataFrame:
    """Tumbling windows with counts between given edges, open at both ends."""
    place = F.lit(0)
    for edge in edges:
        place = place + (F.col("value") >= F.lit(float(edge))).cast("int")
    return events.groupBy(F.window(time, width).alias("window"), "feature_name").agg(
        F.array(*[F.count_if(place == i) for i in range(len(edges) + 1)]).alias("bins")
    )


def alert_stream(
    events: DataFrame,
    threshold: float = THRESHOLD,
    cooldown_seconds: int = COOLDOWN_SECONDS,
    key: str = "entity_id",
    time: str = "event_timestamp",
    delay: str | None = None,
) -> DataFrame:
    """Stateful alerts: per key an alert, then silence for the cooldown, in event time.

    Only candidates reach the keyed state, and the state is one timestamp. Order between
    micro-batches is the order of arrival; inside one, rows are taken by event time. With
    ``delay``, how late an event may be, a key's state ends once the watermark is past its
    cooldown: every later event of the key raises an alert anyway. Without it, keys are kept.
    """
    pause = cooldown_seconds * 1_000_000
    if delay is not None:
        events = events.withWatermark(time, delay)
    candidates = events.filter(F.col("value") > F.lit(float(threshold))).select(
        F.col(key).alias("k"), F.unix_micros(time).alias("t"), F.col(time).alias("moment")
    )

    def decide(
        name: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        # A key's candidates of one micro-batch, eight bytes each.
        times = np.sort(np.concatenate([chunk["t"].to_numpy() for chunk in chunks]))
        hits, at = [], 0 if last is None else np.searchsorted(times, last + pause, side="right")
        while at < len(times):
            last = int(times[at])
            hits.append(last)
            at = np.searchsorted(times, last + pause, side="right")
        if last is not None:
            state.update((last,))
            if delay is not None:
                state.setTimeoutTimestamp(max((last + pause) // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"k": [name[0]] * len(hits), "t": hits})

    fired = candidates.groupBy("k").applyInPandasWithState(
        decide,
        outputStructType="k string, t bigint",
        stateStructType="last bigint",
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout if delay is None else GroupStateTimeout.EventTimeTimeout,
    )
    return fired.select(F.col("k").alias(key), F.timestamp_micros("t").alias("alert_time"))


def on_alerts(
    alerts: DataFrame,
    analysis: Callable[[], DataFrame],
    results: str,
    checkpoint: str,
    trigger: str | None = INGEST_TRIGGER,
) -> StreamingQuery:
    """Run the analysis once for each batch that holds an alert and keep its result."""

    def react(batch: DataFrame, batch_id: int) -> None:
        # A full count: every partition of the keyed state must be read to its end and committed.
        if batch.count():
            replace_batch(analysis(), results, batch_id)

    writer = alerts.writeStream.foreachBatch(react).option("checkpointLocation", checkpoint)
    return paced(writer, trigger).start()


def with_registry(requests: DataFrame, read_registry: Callable[[], DataFrame], path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Join each batch with the registry as it is at that moment."""

    def enrich(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch.join(read_registry(), "model_id", "left"), path, batch_id)

    writer = requests.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint)
    return paced(writer, trigger).start()


def predictions_with_labels(
    predictions: DataFrame, labels: DataFrame, key: str, delay: str, max_lag: Column, unlabelled: bool = False
) -> DataFrame:
    """Stream-stream join: a prediction and the label that arrives within the lag.

    With ``unlabelled``, a prediction whose lag has passed without a label comes too, with nulls,
    once the watermark of the labels is behind it.
    """
    left = predictions.withWatermark("predicted_at", delay).alias("p")
    right = labels.withWatermark("labeled_at", delay).alias("l")
    return left.join(
        right,
        (F.col(f"p.{key}") == F.col(f"l.{key}"))
        & (F.col("l.labeled_at") >= F.col("p.predicted_at"))
        & (F.col("l.labeled_at") <= F.col("p.predicted_at") + max_lag),
        "left" if unlabelled else "inner",
    ).select("p.*", "l.label", "l.labeled_at")


def to_files(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Append finished rows to parquet."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    return paced(writer.option("checkpointLocation", checkpoint), trigger).start()


def updates(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Write the groups that each micro-batch changed under its number; :func:`newest_update` reads them.

    Groups behind the watermark leave the state, and readers never meet a half-written table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch, path, batch_id)

    writer = stream.writeStream.outputMode("update").foreachBatch(write)
    return paced(writer.option("checkpointLocation", checkpoint), trigger).start()


def newest_update(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of every group out of the rows of :func:`updates`, which carry their ``batch``."""
    others = [name for name in rows.columns if name not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("last")).select(*keys, "last.*")
