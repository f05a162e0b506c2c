from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, timetravel
from tidemark.runtime import scratch_path
from tidemark.schemas import FEATURE_LOG
from tidemark.sinks import writers
from tidemark.streaming import feeds

START = datetime(2024, 1, 1)


def write_parts(spark, path, parts, schema):
    """One file per part, in this order."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(query):
    query.awaitTermination()
    return query


EVENT = "entity_id string, value double, event_timestamp timestamp"


def test_alert_state_lasts_over_batches(spark):
    source, target, check = (scratch_path(spark, n) for n in ("events", "alerts", "check"))
    minutes = [[0, 5], [10, 10.5], [12, 20, 21], [40]]
    parts = [[("e", 200.0, START + timedelta(minutes=m)) for m in part] for part in minutes]
    write_parts(spark, source, parts, EVENT)
    fired = feeds.alert_stream(stream(spark, source, EVENT))
    finish(feeds.to_files(fired, target, check))
    got = spark.read.parquet(target)
    batch = alerts.cooldown_alerts(spark.read.parquet(source))
    assert sorted(r.alert_time for r in got.collect()) == sorted(r.alert_time for r in batch.collect())
    assert got.count() == 4


def test_dual_write_over_many_batches_and_a_replay(spark):
    source = scratch_path(spark, "messages")
    text = '{"entity_id":"e%d","feature_name":"f","value":%d,"validated_at":"2024-01-01T00:00:%02dZ","created_at":"2024-01-01T00:00:00Z"}'
    parts = [[(text % (i % 3, i, i),) for i in range(b * 5, b * 5 + 5)] + [("oops",)] for b in range(4)]
    write_parts(spark, source, parts, "value string")
    offline, online, dead, check = (scratch_path(spark, n) for n in ("offline", "online", "dead", "check"))
    messages = stream(spark, source, "value string")
    finish(feeds.dual_write(messages, offline, online, dead, check, trigger=None))
    log = spark.read.schema(FEATURE_LOG).parquet(offline)
    assert log.count() == 20
    assert spark.read.schema("message string, error string").parquet(dead).count() == 4
    merged = feeds.online_view(spark, online)
    assert merged.exceptAll(timetravel.latest_values(log)).isEmpty() and merged.count() == 3
    # The same batch written again changes nothing.
    kept = spark.read.schema(FEATURE_LOG).parquet(f"{offline}/batch=0").drop("event_date").collect()
    again = spark.createDataFrame(kept, FEATURE_LOG).withColumn("event_date", F.to_date("event_timestamp"))
    feeds.replace_batch(again, offline, 0, ("event_date",))
    assert spark.read.schema(FEATURE_LOG).parquet(offline).count() == 20
    assert not feeds.online_store(spark, online).apply(log.withColumn("value", F.lit(-1.0)), 0)
    assert feeds.online_view(spark, online).exceptAll(merged).isEmpty()


def test_replays_in_later_batches_are_dropped(spark):
    source, target, check = (scratch_path(spark, n) for n in ("events", "unique", "check"))
    schema = "event_id int, event_timestamp timestamp"
    rows = [[(i, START + timedelta(minutes=i)) for i in part] for part in ([0, 1, 2], [2, 3], [0, 4])]
    write_parts(spark, source, rows, schema)
    unique = feeds.without_replays(stream(spark, source, schema), ["event_id"], "event_timestamp", "1 hour")
    finish(feeds.to_files(unique, target, check))
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 4]


def test_append_windows_close_behind_the_watermark(spark):
    source, target, check = (scratch_path(spark, n) for n in ("events", "windows", "check"))
    schema = "feature_name string, value double, event_timestamp timestamp"
    parts = [[("f", float(h), START + timedelta(hours=h))] for h in range(6)]
    write_parts(spark, source, parts, schema)
    windows = feeds.hourly_statistics(stream(spark, source, schema), delay="1 hour")
    finish(feeds.to_files(windows, target, check))
    batch = feeds.hourly_statistics(spark.read.parquet(source))
    got = spark.read.parquet(target)
    assert got.exceptAll(batch).isEmpty()
    # The watermark stands one hour behind the newest event, at hour 4: hours 0 to 3 are closed.
    assert sorted(r.low for r in got.collect()) == [0.0, 1.0, 2.0, 3.0]


def test_batches_are_bounded_in_the_unit_of_the_source():
    assert feeds.batch_bound("kafka", rows=5) == {"maxOffsetsPerTrigger": "5"}
    assert feeds.batch_bound("parquet", files=3) == {"maxFilesPerTrigger": "3"}
    assert feeds.batch_bound("json", size="64m") == {"maxBytesPerTrigger": "64m"}
    with pytest.raises(ValueError):
        feeds.batch_bound("parquet", rows=5)


def test_state_of_alerts_ends_and_changes_nothing(spark):
    source, target, check = (scratch_path(spark, n) for n in ("events", "alerts", "check"))
    parts = [[("e", 200.0, START + timedelta(minutes=m)), ("x", 1.0, START + timedelta(minutes=m))] for m in (0, 5, 10.5, 60, 65, 300)]
    # A key that falls silent: its state ends, while "e" has events in every batch.
    parts[0].append(("y", 200.0, START))
    write_parts(spark, source, parts, EVENT)
    running = finish(feeds.to_files(feeds.alert_stream(stream(spark, source, EVENT), delay="1 minute"), target, check))
    batch = alerts.cooldown_alerts(alerts.threshold_candidates(spark.read.parquet(source)))
    assert sorted(r.alert_time for r in spark.read.parquet(target).collect()) == sorted(r.alert_time for r in batch.collect())
    removed = sum(p["stateOperators"][0]["numRowsRemoved"] for p in running.recentProgress if p["stateOperators"])
    assert removed >= 1


def test_updates_leave_the_last_state_of_every_window(spark):
    source, target, check = (scratch_path(spark, n) for n in ("events", "windows", "check"))
    schema = "feature_name string, value double, event_timestamp timestamp"
    parts = [[("f", float(m), START + timedelta(minutes=m))] for m in (0, 20, 70, 50)]
    write_parts(spark, source, parts, schema)
    windows = feeds.hourly_statistics(stream(spark, source, schema), delay="1 hour")
    finish(feeds.updates(windows, target, check))
    batch = feeds.hourly_statistics(spark.read.parquet(source))
    got = feeds.newest_update(spark.read.parquet(target), ["window", "feature_name"])
    assert sorted(got.select("n", "low", "high").collect()) == sorted(batch.select("n", "low", "high").collect())


def test_a_demux_that_failed_halfway_is_tried_again(spark, monkeypatch):
    source, path, check = (scratch_path(spark, n) for n in ("source", "routed", "check"))
    event = '{"table":"features_table","data":{"entity_id":"e%d","feature_name":"f","value":"1.5","event_timestamp":"2024-01-01T00:00:00Z"}}'
    parts = [[(event % i,), ('{"table":"nowhere","data":{}}',), ("{",), (event.replace("1.5", "x") % i,)] for i in range(3)]
    write_parts(spark, source, parts, "message string")
    schemas = {"features_table": FEATURE_LOG, "empty": FEATURE_LOG}
    route, calls = feeds.route_envelopes, []

    def lost(*given, **more):
        calls.append(1)
        route(*given, **more)
        if len(calls) == 2:
            raise OSError("lost after its rows were out")

    monkeypatch.setattr(feeds, "route_envelopes", lost)
    with pytest.raises(Exception):
        feeds.demux(stream(spark, source, "message string"), schemas, path, check, trigger=None).awaitTermination()
    finish(feeds.demux(stream(spark, source, "message string"), schemas, path, check, trigger=None))
    rows = writers.routed(spark, schemas, path, "features_table")
    assert sorted(r.entity_id for r in rows.collect()) == ["e0", "e1", "e2"] and len(calls) == 4
    assert writers.routed(spark, schemas, path, "empty").count() == 0
    errors = sorted(r.error for r in writers.refused(spark, schemas, path).collect())
    assert errors == ["bad value"] * 3 + ["no table"] * 3 + ["unknown table nowhere"] * 3


def test_predictions_without_a_label_come_when_their_lag_is_over(spark):
    said, labels, target, check = (scratch_path(spark, n) for n in ("said", "labels", "joined", "check"))
    write_parts(spark, said, [[(1, START), (2, START)], [(3, START + timedelta(days=30))], [(4, START + timedelta(days=31))]], "event_id int, predicted_at timestamp")
    write_parts(spark, labels, [[(1, 1, START + timedelta(days=1))], [(9, 0, START + timedelta(days=30))], [(9, 0, START + timedelta(days=31))]], "event_id int, label int, labeled_at timestamp")
    joined = feeds.predictions_with_labels(
        stream(spark, said, "event_id int, predicted_at timestamp"),
        stream(spark, labels, "event_id int, label int, labeled_at timestamp"),
        "event_id", "1 hour", F.expr("INTERVAL 3 DAYS"), unlabelled=True,
    )
    finish(feeds.to_files(joined, target, check))
    got = {r.event_id: r.label for r in spark.read.parquet(target).collect()}
    assert got[1] == 1 and got[2] is None and 2 in got


def test_alerts_trigger_the_analysis_only_when_there_are_any(spark):
    source, target, check = (scratch_path(spark, n) for n in ("events", "analysis", "check"))
    write_parts(spark, source, [[("e", 1.0, START)], [("e", 500.0, START)], [("e", 2.0, START)]], EVENT)
    fired = feeds.alert_stream(stream(spark, source, EVENT))
    done = feeds.on_alerts(fired, lambda: spark.range(1).select(F.lit(1).alias("ran")), target, check, trigger=None)
    finish(done)
    assert spark.read.parquet(target).count() == 1
