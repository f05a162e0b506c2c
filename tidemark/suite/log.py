"""Queries on messages, the feature log, the online view, point-in-time joins and alerts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions.text import composite_key
from tidemark.operators import alerts, features, lineage, registry, slices, timetravel
from tidemark.plans import graph, upkeep
from tidemark.runtime import scratch_path
from tidemark.schemas import FEATURE_EVENT, FEATURE_LOG, MODEL_LOG
from tidemark.sinks import days, writers
from tidemark.sources import files, messages, tables
from tidemark.streaming.feeds import hourly_statistics, window_histogram
from tidemark.suite import base
from tidemark.suite.base import clock, feature_log, log_sql, query, sql_clock, table

LOG = f"WITH {log_sql()}"
MESSAGES = f"WITH {base.MESSAGE_SQL}"


def _parsed(spark, sf_dir):
    return messages.parse_messages(base.event_messages(table(spark, sf_dir, "events")))


@query(
    "parse_events",
    f"""{MESSAGES} SELECT entity_id, feature_name, value, {sql_clock('ts')} AS event_timestamp,
        {sql_clock('ts')} AS created_at FROM messages WHERE error IS NULL""",
)
def _(spark, sf_dir):
    good = messages.good_events(_parsed(spark, sf_dir))
    return good.select(
        "entity_id",
        "feature_name",
        "value",
        clock("event_timestamp").alias("event_timestamp"),
        clock("created_at").alias("created_at"),
    )


@query(
    "dead_letters",
    f"{MESSAGES} SELECT error, count(*) AS n FROM messages WHERE error IS NOT NULL GROUP BY error",
)
def _(spark, sf_dir):
    refused = messages.dead_letters(_parsed(spark, sf_dir))
    return refused.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "raw_to_features",
    f"""SELECT 'user_' || user_id AS entity_id, event_type AS feature_name,
        CAST(props ->> '$.k' AS DOUBLE) AS value, {sql_clock('ts')} AS event_timestamp FROM events""",
)
def _(spark, sf_dir):
    actions = table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_type").alias("action"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("props").alias("payload"),
    )
    return features.from_actions(actions).select(
        "entity_id", "feature_name", "value", clock("event_timestamp").alias("event_timestamp")
    )


@query(
    "validate_events",
    f"""{LOG}, suspect AS (
      SELECT CASE WHEN event_id % 19 = 0 THEN '' ELSE entity_id END AS entity_id,
             CASE WHEN event_id % 23 = 0 THEN 'mystery' WHEN event_id % 29 = 0 THEN NULL
                  ELSE feature_name END AS feature_name,
             CASE WHEN event_id % 31 = 0 THEN NULL ELSE value END AS value FROM log)
    SELECT reason, count(*) AS n FROM (
      SELECT CASE WHEN entity_id = '' THEN 'missing entity' WHEN feature_name IS NULL THEN 'missing feature'
                  WHEN feature_name = 'mystery' THEN 'unknown feature'
                  WHEN value IS NULL THEN 'value is no number' ELSE 'valid' END AS reason FROM suspect)
    GROUP BY reason""",
)
def _(spark, sf_dir):
    log, n = feature_log(spark, sf_dir), F.col("event_id")
    suspect = log.withColumns(
        {
            "entity_id": F.when(n % 19 == 0, "").otherwise(F.col("entity_id")),
            "feature_name": F.when(n % 23 == 0, "mystery")
            .when(n % 29 == 0, F.lit(None))
            .otherwise(F.col("feature_name")),
            "value": F.when(n % 31 != 0, F.col("value").cast("string")),
        }
    )
    checked = features.validate(suspect, log.select("feature_name").distinct())
    return checked.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "critical_split",
    f"{LOG} SELECT event_id, feature_name FROM log WHERE feature_name IN ('purchase', 'error')",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    critical = log.select("feature_name").distinct().filter(
        F.col("feature_name").isin("purchase", "error")
    )
    return features.critical_only(log, critical).select("event_id", "feature_name")


@query(
    "ingest_union",
    f"""{MESSAGES} SELECT entity_id, feature_name, count(*) AS n, round(sum(value), 6) AS total FROM (
      SELECT entity_id, feature_name, value FROM messages WHERE error IS NULL
      UNION ALL SELECT entity_id, feature_name, value FROM messages) GROUP BY entity_id, feature_name""",
)
def _(spark, sf_dir):
    # The same events once as messages, once out of JSON and parquet files in one folder.
    folder = scratch_path(spark, "uploads")
    log = feature_log(spark, sf_dir)
    upload = log.withColumnRenamed("event_timestamp", "validated_at").drop("event_id")
    even = F.pmod(F.xxhash64("entity_id"), F.lit(2)) == 0
    # Small arrays of one event each: the reader expands them, and no task gathers a large one.
    arrays = upload.filter(even).select(
        F.to_json(F.array(F.struct(*upload.columns))).alias("value")
    )
    arrays.write.text(f"{folder}/json")
    upload.filter(~even).write.parquet(f"{folder}/parquet")
    from_json = spark.read.schema(FEATURE_EVENT).json(f"{folder}/json")
    from_parquet = files.read_parquet_events(spark, f"{folder}/parquet")
    uploaded = messages.to_log(from_json.unionByName(from_parquet))
    streamed = messages.good_events(_parsed(spark, sf_dir))
    return (
        streamed.unionByName(uploaded)
        .groupBy("entity_id", "feature_name")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
    )


@query(
    "dedup_events",
    f"{LOG} SELECT event_id, entity_id, feature_name FROM log",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    replayed = log.unionByName(log.filter(F.col("event_id") % 3 == 0))
    return replayed.dropDuplicates(["event_id"]).select("event_id", "entity_id", "feature_name")


def write_envelopes(events):
    """Envelopes for two tables, with missing, extra and unreadable parts."""
    n = F.col("event_id")
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    feature = F.to_json(
        F.struct(
            F.lit("features_table").alias("table"),
            F.struct(
                F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("entity_id"),
                F.col("event_type").alias("feature_name"),
                F.col("value").alias("value"),
                F.when(n % 41 == 0, F.lit("soon")).otherwise(moment).alias("event_timestamp"),
                F.lit("ignored").alias("extra"),
            ).alias("data"),
        )
    )
    logged = F.to_json(
        F.struct(
            F.lit("model_logs").alias("table"),
            F.struct(
                F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")).alias("model_id"),
                F.format_string("%f", F.col("value")).alias("model_result"),
                moment.alias("event_datetime"),
            ).alias("data"),
        )
    )
    body = F.when(n % 43 == 0, F.lit("{oops")).when(n % 2 == 0, feature).otherwise(logged)
    return events.select("event_id", body.alias("message"))


DEMUX_SQL = f"""SELECT 'features_table' AS target, 'user_' || user_id AS key, event_type AS detail,
        {sql_clock('ts')} AS moment, '' AS error FROM events
    WHERE event_id % 43 <> 0 AND event_id % 2 = 0 AND event_id % 41 <> 0
    UNION ALL SELECT 'model_logs', 'm' || (user_id % 5), printf('%.6f', value), {sql_clock('ts')}, ''
    FROM events WHERE event_id % 43 <> 0 AND event_id % 2 = 1
    UNION ALL SELECT 'dead', '', '', '', 'bad event_timestamp' FROM events
    WHERE event_id % 43 <> 0 AND event_id % 82 = 0
    UNION ALL SELECT 'dead', '', '', '', 'no table' FROM events WHERE event_id % 43 = 0"""


TABLES = {"features_table": FEATURE_LOG, "model_logs": MODEL_LOG}


def demuxed(spark, path):
    """The three targets of a demux as one comparable table."""
    empty = F.lit("")
    rows = writers.routed(spark, TABLES, path, "features_table").select(
        F.lit("features_table").alias("target"),
        F.col("entity_id").alias("key"),
        F.col("feature_name").alias("detail"),
        clock("event_timestamp").alias("moment"),
        empty.alias("error"),
    )
    logs = writers.routed(spark, TABLES, path, "model_logs").select(
        F.lit("model_logs").alias("target"),
        F.col("model_id").alias("key"),
        F.col("model_result").alias("detail"),
        clock("event_datetime").alias("moment"),
        empty.alias("error"),
    )
    dead = writers.refused(spark, TABLES, path).select(
        F.lit("dead").alias("target"),
        empty.alias("key"),
        empty.alias("detail"),
        empty.alias("moment"),
        "error",
    )
    return rows.unionByName(logs).unionByName(dead)


@query("demux_writes", DEMUX_SQL)
def _(spark, sf_dir):
    path = scratch_path(spark, "routed")
    writers.route_envelopes(write_envelopes(table(spark, sf_dir, "events")), TABLES, path)
    return demuxed(spark, path)


@query(
    "offline_append",
    f"""{LOG} SELECT event_id, entity_id, feature_name, value, {sql_clock('event_timestamp')} AS event_timestamp,
        strftime(event_timestamp, '%Y-%m-%d') AS event_date FROM log WHERE feature_name = 'purchase'""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "offline")
    log = feature_log(spark, sf_dir)
    writers.append_offline(log.filter(F.col("event_timestamp") < F.lit("2024-01-11")), path)
    writers.append_offline(log.filter(F.col("event_timestamp") >= F.lit("2024-01-11")), path)
    stored = features.of_feature(spark.read.parquet(path), "purchase")
    return stored.select(
        "event_id",
        "entity_id",
        "feature_name",
        "value",
        clock("event_timestamp").alias("event_timestamp"),
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
    )


@query(
    "json_rows",
    """SELECT '{"event_type":"' || event_type || '","n":' || count(*) || '}' AS row
    FROM events GROUP BY event_type""",
)
def _(spark, sf_dir):
    sql = f"SELECT event_type, count(*) AS n FROM parquet.`{sf_dir}/events.parquet` GROUP BY event_type"
    rows, error = tables.query_as_json(spark, sql)
    if rows is None:
        raise ValueError(error)
    return rows


# --- online view -------------------------------------------------------------------------

_LATEST = f"""{LOG}, latest AS (
      SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY entity_id, feature_name
                    ORDER BY event_timestamp DESC, created_at DESC, event_id DESC) AS place FROM log)
      WHERE place = 1)"""


@query(
    "online_latest",
    f"""{_LATEST} SELECT entity_id || ':' || feature_name AS key, value,
        {sql_clock('event_timestamp')} AS event_timestamp FROM latest""",
)
def _(spark, sf_dir):
    latest = timetravel.latest_values(feature_log(spark, sf_dir))
    return latest.select(
        composite_key(F.col("entity_id"), F.col("feature_name")).alias("key"),
        "value",
        clock("event_timestamp").alias("event_timestamp"),
    )


@query(
    "online_json",
    f"""{_LATEST} SELECT entity_id || ':' || feature_name AS key,
        strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, value AS val FROM latest""",
)
def _(spark, sf_dir):
    entries = timetravel.online_entries(timetravel.latest_values(feature_log(spark, sf_dir)))
    return entries.select(
        "key", F.inline(F.array(F.from_json("value", "val double, timestamp string")))
    )


_NAMES = [(2, "purchase"), (0, "view"), (1, "click")]


@query(
    "entity_vector",
    f"""{_LATEST} SELECT entity_id, max(value) FILTER (WHERE feature_name = 'view') AS view,
        max(value) FILTER (WHERE feature_name = 'click') AS click,
        max(value) FILTER (WHERE feature_name = 'purchase') AS purchase
    FROM latest WHERE feature_name IN ('view', 'click', 'purchase') GROUP BY entity_id""",
)
def _(spark, sf_dir):
    return features.entity_vector(timetravel.latest_values(feature_log(spark, sf_dir)), _NAMES)


@query(
    "hydrate",
    f"""{_LATEST}, requests AS (
      SELECT o_orderkey AS request_id, 'user_' || o_custkey AS entity_id FROM orders),
    names(index, feature_name) AS (VALUES (0, 'purchase'), (1, 'view'), (2, 'refund'))
    SELECT request_id, CAST(index AS INTEGER) AS index, feature_name, value
    FROM requests CROSS JOIN names LEFT JOIN latest USING (entity_id, feature_name)""",
)
def _(spark, sf_dir):
    requests = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("entity_id"),
        F.array(F.lit("purchase"), F.lit("view"), F.lit("refund")).alias("feature_names"),
    )
    latest = timetravel.latest_values(feature_log(spark, sf_dir))
    found = timetravel.hydrate(requests, latest)
    return found.select("request_id", "index", "feature_name", "value")


# --- point-in-time joins -----------------------------------------------------------------


def label_rows(log, feature="view"):
    """Every purchase is a label; it asks for the entity's value of one feature."""
    return log.filter(F.col("feature_name") == "purchase").select(
        F.col("event_id").alias("label_id"),
        "entity_id",
        F.lit(feature).alias("feature_name"),
        F.col("event_timestamp").alias("label_time"),
    )


@query(
    "pit_join",
    f"""{LOG}, labels_at AS (SELECT event_id AS label_id, entity_id, event_timestamp AS label_time FROM log
                             WHERE feature_name = 'purchase'),
    seen AS (SELECT * FROM log WHERE feature_name = 'view')
    SELECT l.label_id, l.entity_id, {sql_clock('l.label_time')} AS label_time, s.value,
           {sql_clock('s.event_timestamp')} AS event_timestamp
    FROM labels_at l ASOF LEFT JOIN seen s
      ON l.entity_id = s.entity_id AND l.label_time >= s.event_timestamp""",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    joined = timetravel.pit_join(label_rows(log), log)
    return joined.select(
        "label_id",
        "entity_id",
        clock("label_time").alias("label_time"),
        "value",
        clock("event_timestamp").alias("event_timestamp"),
    )


@query(
    "pit_join_bitemporal",
    f"""WITH {log_sql(delayed=True)},
    pairs AS (
      SELECT l.event_id AS label_id, s.value, s.event_timestamp,
             row_number() OVER (PARTITION BY l.event_id ORDER BY s.event_timestamp DESC, s.created_at DESC) AS place
      FROM log l LEFT JOIN log s ON s.entity_id = l.entity_id AND s.feature_name = 'view'
        AND s.event_timestamp <= l.event_timestamp AND s.created_at <= l.event_timestamp
      WHERE l.feature_name = 'purchase')
    SELECT label_id, CASE WHEN event_timestamp >= (SELECT event_timestamp FROM log WHERE event_id = label_id) - INTERVAL 10 DAYS
                          THEN value END AS value FROM pairs WHERE place = 1""",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir, delayed=True)
    joined = timetravel.pit_join(
        label_rows(log), log, bitemporal=True, max_age=F.expr("INTERVAL 10 DAYS")
    )
    return joined.select("label_id", "value")


@query(
    "training_set",
    f"""{LOG}, labels_at AS (SELECT event_id AS label_id, entity_id, event_timestamp AS label_time, value AS label
                             FROM log WHERE feature_name = 'purchase')
    SELECT l.label_id, l.label, v.value AS view, c.value AS click, s.value AS signup
    FROM labels_at l
    ASOF LEFT JOIN (SELECT * FROM log WHERE feature_name = 'view') v ON l.entity_id = v.entity_id AND l.label_time >= v.event_timestamp
    ASOF LEFT JOIN (SELECT * FROM log WHERE feature_name = 'click') c ON l.entity_id = c.entity_id AND l.label_time >= c.event_timestamp
    ASOF LEFT JOIN (SELECT * FROM log WHERE feature_name = 'signup') s ON l.entity_id = s.entity_id AND l.label_time >= s.event_timestamp""",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    labels = log.filter(F.col("feature_name") == "purchase").select(
        F.col("event_id").alias("label_id"),
        "entity_id",
        F.col("event_timestamp").alias("label_time"),
        F.col("value").alias("label"),
    )
    wide = timetravel.training_set(labels, log, ["view", "click", "signup"])
    return wide.select("label_id", "label", "view", "click", "signup")


@query(
    "train_window",
    f"""{LOG} SELECT feature_name, count(*) AS n, round(sum(value), 6) AS total FROM log
    WHERE event_timestamp >= (SELECT max(event_timestamp) FROM log) - INTERVAL 20 DAYS GROUP BY feature_name""",
)
def _(spark, sf_dir):
    recent = timetravel.training_window(feature_log(spark, sf_dir), days=20)
    return recent.groupBy("feature_name").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")
    )


@query(
    "ordered_page",
    f"""{LOG} SELECT event_id, value FROM log WHERE feature_name = 'click'
    ORDER BY event_timestamp LIMIT 100 OFFSET 50""",
)
def _(spark, sf_dir):
    # Offset and limit are the operator here: one page of a feature in time order.
    return slices.events_in_order(feature_log(spark, sf_dir), "click", 50, 100).select(
        "event_id", "value"
    )


# --- alerts ------------------------------------------------------------------------------


@query("threshold_alerts", f"{LOG} SELECT event_id, entity_id, value FROM log WHERE value > 100")
def _(spark, sf_dir):
    return alerts.threshold_candidates(feature_log(spark, sf_dir)).select(
        "event_id", "entity_id", "value"
    )


@query(
    "first_alerts",
    f"""{LOG} SELECT strftime(event_timestamp, '%Y-%m-%d') AS batch, arg_min(event_id, event_timestamp) AS event_id,
        arg_min(entity_id, event_timestamp) AS entity_id FROM log WHERE value > 100 GROUP BY 1""",
)
def _(spark, sf_dir):
    daily = feature_log(spark, sf_dir).withColumn(
        "batch", F.date_format("event_timestamp", "yyyy-MM-dd")
    )
    return alerts.first_alert(daily, ["batch"]).select("batch", "event_id", "entity_id")


@query(
    "three_sigma",
    f"""{LOG}, limits AS (SELECT feature_name, avg(value) + 3 * stddev_samp(value) AS upper_limit
                          FROM log GROUP BY feature_name)
    SELECT event_id, feature_name, value FROM log JOIN limits USING (feature_name) WHERE value > upper_limit""",
)
def _(spark, sf_dir):
    return alerts.three_sigma(feature_log(spark, sf_dir)).select("event_id", "feature_name", "value")


COOLDOWN_SQL = f"""WITH RECURSIVE {log_sql()},
    candidates AS (SELECT entity_id, event_timestamp FROM log WHERE value > 100),
    fired(entity_id, alert_time) AS (
      SELECT entity_id, min(event_timestamp) FROM candidates GROUP BY entity_id
      UNION ALL
      SELECT entity_id, alert_time FROM (
        SELECT f.entity_id, (SELECT min(c.event_timestamp) FROM candidates c
               WHERE c.entity_id = f.entity_id AND c.event_timestamp > f.alert_time + INTERVAL 1 DAY) AS alert_time
        FROM fired f) WHERE alert_time IS NOT NULL)
    SELECT entity_id, {sql_clock('alert_time')} AS alert_time FROM fired"""


@query("cooldown_alerts", COOLDOWN_SQL)
def _(spark, sf_dir):
    candidates = alerts.threshold_candidates(feature_log(spark, sf_dir))
    fired = alerts.cooldown_alerts(candidates, cooldown_seconds=86_400)
    return fired.select("entity_id", clock("alert_time").alias("alert_time"))


# --- windows and derived features --------------------------------------------------------

HOURLY_SQL = f"""{LOG} SELECT {sql_clock("date_trunc('hour', event_timestamp)")} AS hour, feature_name, count(*) AS n,
        round(avg(value), 9) AS mean, round(stddev_samp(value), 8) AS std, min(value) AS low, max(value) AS high
    FROM log GROUP BY date_trunc('hour', event_timestamp), feature_name"""


def flat_windows(windows):
    return windows.select(
        clock("window.start").alias("hour"),
        "feature_name",
        "n",
        F.round("mean", 9).alias("mean"),
        F.round("std", 8).alias("std"),
        "low",
        "high",
    )


@query("hourly_windows", HOURLY_SQL)
def _(spark, sf_dir):
    return flat_windows(hourly_statistics(feature_log(spark, sf_dir)))


@query(
    "window_histograms",
    f"""{LOG} SELECT {sql_clock("date_trunc('day', event_timestamp)")} AS day, feature_name,
        count(*) FILTER (WHERE value < 25) AS b0, count(*) FILTER (WHERE value >= 25 AND value < 75) AS b1,
        count(*) FILTER (WHERE value >= 75) AS b2 FROM log GROUP BY date_trunc('day', event_timestamp), feature_name""",
)
def _(spark, sf_dir):
    windows = window_histogram(feature_log(spark, sf_dir), [25.0, 75.0], width="1 day")
    return windows.select(
        clock("window.start").alias("day"),
        "feature_name",
        *[F.col("bins")[i].alias(f"b{i}") for i in range(3)],
    )


@query(
    "derived_features",
    f"""{LOG} SELECT event_id, feature_name || '_7d' AS feature_name, CAST(count(*) OVER (
        PARTITION BY entity_id, feature_name ORDER BY event_timestamp
        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM log
    UNION ALL SELECT event_id, 'click_doubled', value * 2 FROM log WHERE feature_name = 'click'""",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    trailing = upkeep.trailing_feature(log, 7).select("event_id", "feature_name", "value")
    doubled = upkeep.transformed(log, "click_doubled", "click", lambda value: value * 2)
    return trailing.unionByName(doubled.select("event_id", "feature_name", "value"))


@query(
    "python_transform",
    f"{LOG} SELECT event_id, feature_name, round(value * 2 + 1, 6) AS value FROM log",
)
def _(spark, sf_dir):
    def scaled(batch):
        return batch.assign(value=batch["value"] * 2 + 1)

    changed = upkeep.transformed_in_batches(feature_log(spark, sf_dir), scaled)
    return changed.select("event_id", "feature_name", F.round("value", 6).alias("value"))


@query(
    "backfill_range",
    f"""{LOG}, counted AS (
      SELECT event_id, feature_name, event_timestamp, CAST(count(*) OVER (
        PARTITION BY entity_id, feature_name ORDER BY event_timestamp
        RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM log)
    SELECT event_id, feature_name || '_3d' AS feature_name,
           CASE WHEN event_timestamp >= TIMESTAMP '2024-01-10' AND event_timestamp < TIMESTAMP '2024-01-15'
                THEN value ELSE CAST(0 AS DOUBLE) END AS value FROM counted""",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    derived = days.DayTable(spark, scratch_path(spark, "derived"), DERIVED)
    # A first, faulty version of the derived feature, then the backfill of five days, twice.
    faulty = log.withColumns(
        {
            "feature_name": F.concat(F.col("feature_name"), F.lit("_3d")),
            "value": F.lit(0.0),
        }
    )
    derived.append(faulty)
    for _attempt in range(2):
        upkeep.backfill(log, date(2024, 1, 10), date(2024, 1, 15), lambda rows: upkeep.trailing_feature(rows, 3), derived)
    return derived.read().select("event_id", "feature_name", "value")


DERIVED = "event_id long, entity_id string, feature_name string, value double, event_timestamp timestamp, created_at timestamp"

# Two counts of one feature, their ratio, and a mark on the ratio; a correction of two days doubles the events there.
_DOUBLED = "event_timestamp >= TIMESTAMP '2024-01-10' AND event_timestamp < TIMESTAMP '2024-01-12'"


@query(
    "derived_graph",
    f"""{LOG}, changed AS (
      SELECT event_id, entity_id, event_timestamp FROM log WHERE feature_name = 'view'
      UNION ALL SELECT event_id + 1000000000, entity_id, event_timestamp FROM log WHERE feature_name = 'view' AND {_DOUBLED}),
    counted AS (
      SELECT *, count(*) OVER (PARTITION BY entity_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS d1,
        count(*) OVER (PARTITION BY entity_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND CURRENT ROW) AS d3 FROM changed)
    SELECT event_id, 'view_1d' AS feature_name, CAST(d1 AS DOUBLE) AS value FROM counted
    UNION ALL SELECT event_id, 'view_3d', CAST(d3 AS DOUBLE) FROM counted
    UNION ALL SELECT event_id, 'view_share', round(d1 / d3, 9) FROM counted
    UNION ALL SELECT event_id, 'view_rush', CASE WHEN d1 / d3 > 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END FROM counted""",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir).filter(F.col("feature_name") == "view")
    derived = days.DayTable(spark, scratch_path(spark, "derived"), DERIVED)

    def share(rows):
        one, three = (rows.filter(F.col("feature_name") == name) for name in ("view_1d", "view_3d"))
        both = one.join(three.select("event_id", F.col("value").alias("of")), "event_id")
        return both.withColumns({"feature_name": F.lit("view_share"), "value": F.round(F.col("value") / F.col("of"), 9)}).drop("of")

    steps = [
        graph.Step("view_rush", ("view_share",), lambda rows: upkeep.transformed(rows, "view_rush", "view_share", lambda v: (v > 0.5).cast("double"))),
        graph.Step("view_share", ("view_1d", "view_3d"), share),
        graph.Step("view_1d", ("view",), lambda rows: upkeep.trailing_feature(rows, 1), look_back=1),
        graph.Step("view_3d", ("view",), lambda rows: upkeep.trailing_feature(rows, 3), look_back=3),
    ]
    graph.recompute(log, steps, derived, {"view": (date(2024, 1, 1), date(2024, 2, 1))})
    moment = F.col("event_timestamp")
    again = log.filter((moment >= F.lit("2024-01-10").cast("timestamp")) & (moment < F.lit("2024-01-12").cast("timestamp")))
    corrected = log.unionByName(again.withColumn("event_id", F.col("event_id") + 1_000_000_000))
    graph.recompute(corrected, steps, derived, {"view": (date(2024, 1, 10), date(2024, 1, 12))})
    return derived.read().select("event_id", "feature_name", "value")


@query(
    "lineage_closure",
    f"""WITH RECURSIVE {base.REGISTRY_SQL},
    edges AS (
      SELECT DISTINCT event_type || '_1d' AS output, event_type AS input FROM events
      UNION SELECT DISTINCT event_type || '_7d', event_type || '_1d' FROM events
      UNION SELECT DISTINCT 'model:' || model_id, feature_name || '_7d' FROM model_features),
    reach(output, input, depth) AS (
      SELECT output, input, 1 FROM edges
      UNION SELECT r.output, e.input, r.depth + 1 FROM reach r JOIN edges e ON r.input = e.output)
    SELECT output, input, CAST(min(depth) AS INTEGER) AS depth FROM reach GROUP BY output, input""",
)
def _(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.col("event_type").alias("input")).distinct()
    daily = raw.select(F.concat(F.col("input"), F.lit("_1d")).alias("output"), "input")
    weekly = raw.select(
        F.concat(F.col("input"), F.lit("_7d")).alias("output"),
        F.concat(F.col("input"), F.lit("_1d")).alias("input"),
    )
    used = registry.model_features(base.registry(spark, sf_dir)).select(
        F.concat(F.lit("model:"), F.col("model_id")).alias("output"),
        F.concat(F.col("feature_name"), F.lit("_7d")).alias("input"),
    )
    edges = upkeep.lineage_rows(daily.unionByName(weekly).unionByName(used), "1")
    return lineage.dependency_closure(edges)
