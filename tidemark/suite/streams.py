"""Streaming twins: each runs over everything there is, then its result is compared like a batch query.

Where state, order or replays matter, the events arrive in parts, and the stream starts anew from its
checkpoint after each of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import registry as registry_ops
from tidemark.operators import sketch
from tidemark.runtime import scratch_path
from tidemark.schemas import FEATURE_LOG
from tidemark.streaming import feeds, windows
from tidemark.suite import base, log, models
from tidemark.suite.base import clock, log_sql, query, sql_clock, table


def event_stream(spark, sf_dir):
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def as_log(events):
    moment = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("entity_id"),
        F.col("event_type").alias("feature_name"),
        "value",
        moment.alias("event_timestamp"),
        moment.alias("created_at"),
    )


def log_stream(spark, sf_dir):
    return as_log(event_stream(spark, sf_dir))


# Sixteen days are a part. Some rows arrive with the part after their own, late or once more.
PART_SQL = "(day(ts) - 1) // 16"
PARTS = 3


def in_parts(spark, sf_dir, start, delayed=None, repeated=None):
    """Write the events part by part; after each, run the stream that ``start`` begins to its end."""
    events = table(spark, sf_dir, "events")
    own = F.floor((F.dayofmonth("ts") - 1) / 16)
    arrives = own if delayed is None else own + delayed.cast("int")
    arriving = events.withColumn("part", arrives)
    if repeated is not None:
        arriving = arriving.unionByName(events.filter(repeated).withColumn("part", own + 1))
    (source,) = places(spark, "arriving")
    for part in range(PARTS):
        arriving.filter(F.col("part") == part).drop("part").write.mode("append").parquet(source)
        finished(start(spark.readStream.schema(events.schema).parquet(source)))


def finished(running):
    """Wait until the stream has read all of its input."""
    running.awaitTermination()
    return running


def places(spark, *names):
    return [scratch_path(spark, name) for name in names]


def _written(spark, sf_dir):
    offline, online, dead, checkpoint = places(spark, "offline", "online", "dead", "check")
    late = F.col("event_id") % 37 == 0
    in_parts(
        spark,
        sf_dir,
        lambda events: feeds.dual_write(base.event_messages(events), offline, online, dead, checkpoint, trigger=None),
        delayed=late,
    )
    return offline, online, dead


@query(
    "stream_offline",
    f"""WITH {base.MESSAGE_SQL} SELECT entity_id, feature_name, value, {sql_clock('ts')} AS event_timestamp
    FROM messages WHERE error IS NULL""",
)
def _(spark, sf_dir):
    offline, _, _ = _written(spark, sf_dir)
    return spark.read.schema(FEATURE_LOG).parquet(offline).select(
        "entity_id", "feature_name", "value", clock("event_timestamp").alias("event_timestamp")
    )


@query(
    "stream_online",
    f"""WITH {base.MESSAGE_SQL} SELECT entity_id, feature_name, arg_max(value, ts) AS value FROM messages
    WHERE error IS NULL GROUP BY entity_id, feature_name""",
)
def _(spark, sf_dir):
    _, online, _ = _written(spark, sf_dir)
    merged = feeds.online_view(spark, online)
    return merged.select("entity_id", "feature_name", "value")


@query(
    "stream_dead_letters",
    f"WITH {base.MESSAGE_SQL} SELECT error, count(*) AS n FROM messages WHERE error IS NOT NULL GROUP BY error",
)
def _(spark, sf_dir):
    _, _, dead = _written(spark, sf_dir)
    rows = spark.read.schema("message string, error string").parquet(dead)
    return rows.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("stream_demux", log.DEMUX_SQL)
def _(spark, sf_dir):
    path, checkpoint = places(spark, "routed", "check")
    in_parts(spark, sf_dir, lambda events: feeds.demux(log.write_envelopes(events), log.TABLES, path, checkpoint, trigger=None))
    return log.demuxed(spark, path)


@query("stream_dedup", f"WITH {log_sql()} SELECT event_id, entity_id FROM log")
def _(spark, sf_dir):
    path, checkpoint = places(spark, "unique", "check")

    def start(events):
        # Every row twice in its part, some once more with the next one.
        replayed = as_log(events).withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
        unique = feeds.without_replays(replayed, ["event_id"], "event_timestamp", "1 day")
        return feeds.to_files(unique.select("event_id", "entity_id"), path, checkpoint)

    in_parts(spark, sf_dir, start, repeated=F.col("event_id") % 5 == 0)
    return spark.read.schema("event_id bigint, entity_id string").parquet(path)


def _windows_kept(spark, sf_dir):
    """Hourly windows of events of which some come a part late, and the marked log."""
    offline, kept, checkpoint = places(spark, "offline", "windows", "check")
    in_parts(
        spark,
        sf_dir,
        lambda events: windows.windowed_write(as_log(events), offline, kept, checkpoint, "2 hours", EDGES, trigger=None),
        delayed=F.col("event_id") % 37 == 0,
    )
    return offline, kept


EDGES = [25.0, 75.0]


@query("stream_hourly", log.HOURLY_SQL)
def _(spark, sf_dir):
    offline, kept = _windows_kept(spark, sf_dir)
    for _attempt in range(2):
        windows.add_late_rows(spark, offline, kept, EDGES)
    return windows.statistics(windows.window_store(spark, kept).read()).select(
        clock("window_start").alias("hour"),
        "feature_name",
        "n",
        F.round("mean", 9).alias("mean"),
        F.round("std", 8).alias("std"),
        "low",
        "high",
    )


# Which rows were late, and what the windows without them hold.
LATE_SQL = f"""WITH {log_sql()},
    arriving AS (SELECT l.*, {PART_SQL.replace('ts', 'event_timestamp')} + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END AS part FROM log l),
    newest AS (SELECT part, max(event_timestamp) AS newest FROM arriving GROUP BY part),
    marked AS (
      SELECT a.*, coalesce(date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR <=
        (SELECT max(newest) FROM newest n WHERE n.part < a.part) - INTERVAL 2 HOURS, false) AS late FROM arriving a)
    SELECT event_id, late, count(*) FILTER (NOT late) OVER (PARTITION BY feature_name, date_trunc('hour', event_timestamp)) AS in_window,
      count(*) FILTER (NOT late AND value < 25) OVER (PARTITION BY feature_name, date_trunc('hour', event_timestamp)) AS low_in_window
    FROM marked"""


@query("stream_late_rows", LATE_SQL)
def _(spark, sf_dir):
    offline, kept = _windows_kept(spark, sf_dir)
    rows = spark.read.parquet(offline).select(
        "event_id", "late", "feature_name", windows.window_start("event_timestamp", "1 hour").alias("window_start")
    )
    held = windows.window_store(spark, kept).read().select("window_start", "feature_name", "n", F.col("bins")[0].alias("low"))
    return rows.join(held, ["window_start", "feature_name"], "left").select(
        "event_id",
        "late",
        F.coalesce("n", F.lit(0)).alias("in_window"),
        F.coalesce("low", F.lit(0)).alias("low_in_window"),
    )


@query(
    "stream_window_updates",
    log.HOURLY_SQL,
)
def _(spark, sf_dir):
    path, checkpoint = places(spark, "hourly", "check")
    changed = log.flat_windows(feeds.hourly_statistics(log_stream(spark, sf_dir), delay="2 hours"))
    finished(feeds.updates(changed, path, checkpoint))
    return feeds.newest_update(spark.read.parquet(path), ["hour", "feature_name"])


@query("stream_cooldown", log.COOLDOWN_SQL)
def _(spark, sf_dir):
    path, checkpoint = places(spark, "alerts", "check")

    def start(events):
        fired = feeds.alert_stream(as_log(events), cooldown_seconds=86_400, delay="1 hour")
        return feeds.to_files(fired, path, checkpoint)

    in_parts(spark, sf_dir, start)
    stored = spark.read.schema("entity_id string, alert_time timestamp").parquet(path)
    return stored.select("entity_id", clock("alert_time").alias("alert_time"))


@query(
    "stream_alert_analysis",
    f"""WITH {log_sql()} SELECT count(value) AS total_weight, round(avg(value), 6) AS calculated_mean FROM log
    WHERE event_timestamp > (SELECT max(event_timestamp) FROM log) - INTERVAL 36 HOURS""",
)
def _(spark, sf_dir):
    path, checkpoint = places(spark, "analysis", "check")
    alerts = feeds.alert_stream(log_stream(spark, sf_dir))
    rows = base.feature_log(spark, sf_dir)

    def analysis():
        return sketch.analyze_interval(rows, "value", F.expr("INTERVAL 36 HOURS"))

    finished(feeds.on_alerts(alerts, analysis, path, checkpoint, trigger=None))
    return spark.read.parquet(path).select(
        "total_weight", F.round("calculated_mean", 6).alias("calculated_mean")
    )


@query(
    "stream_registry_lookup",
    f"""{models.REGISTRY}, {base.PREDICTION_SQL}
    SELECT p.event_id, p.model_id, n.version FROM predictions p LEFT JOIN newest n USING (model_id)""",
)
def _(spark, sf_dir):
    path, checkpoint = places(spark, "enriched", "check")
    requests = event_stream(spark, sf_dir).select(
        "event_id", F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")).alias("model_id")
    )

    def current():
        live = base.registry(spark, sf_dir).filter(F.col("status") == "production")
        return registry_ops.current_versions(live).select("model_id", "version")

    finished(feeds.with_registry(requests, current, path, checkpoint))
    return spark.read.parquet(path).select("event_id", "model_id", "version")


@query(
    "stream_labels",
    f"""WITH {base.PREDICTION_SQL}, {base.LABEL_SQL}
    SELECT p.event_id, l.label, {sql_clock('l.labeled_at')} AS labeled_at FROM predictions p JOIN late_labels l
      ON l.event_id = p.event_id AND l.labeled_at BETWEEN p.predicted_at AND p.predicted_at + INTERVAL 3 DAYS""",
)
def _(spark, sf_dir):
    path, checkpoint = places(spark, "labeled", "check")
    n, moment = F.col("event_id"), F.col("ts").cast("timestamp")
    predicted = event_stream(spark, sf_dir).select("event_id", moment.alias("predicted_at"))
    labels = (
        event_stream(spark, sf_dir)
        .filter(n % 7 != 0)
        .select(
            "event_id",
            (F.get_json_object("props", "$.k").cast("int") > 50).cast("int").alias("label"),
            (moment + F.make_dt_interval(days=n % 5)).alias("labeled_at"),
        )
    )
    joined = feeds.predictions_with_labels(
        predicted, labels, "event_id", "1 day", F.expr("INTERVAL 3 DAYS")
    )
    finished(feeds.to_files(joined, path, checkpoint))
    stored = spark.read.schema(
        "event_id bigint, predicted_at timestamp, label int, labeled_at timestamp"
    ).parquet(path)
    return stored.select("event_id", "label", clock("labeled_at").alias("labeled_at"))
