"""What is written on the way, and when it goes."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.operators import alerts, drift
from tidemark.operators.slices import positional_slices


def folders(spark):
    root = runtime.scratch_root(spark)
    return {name for name in os.listdir(root)} if os.path.isdir(root) else set()


def test_intermediates_end_with_their_lifetime(spark):
    log = spark.range(400).select(
        F.concat(F.lit("e"), F.col("id") % 3).alias("entity_id"),
        F.concat(F.lit("f"), F.col("id") % 2).alias("feature_name"),
        (F.col("id") % 17).cast("double").alias("value"),
        F.timestamp_seconds(F.col("id") * 400).alias("event_timestamp"),
        F.timestamp_seconds(F.col("id") * 400).alias("created_at"),
    )
    want = sorted(map(str, drift.feature_drift(positional_slices(log)).collect()))
    fired = sorted(map(str, alerts.cooldown_alerts(log).collect()))
    before = folders(spark)
    with runtime.lifetime(spark):
        report = runtime.kept(drift.feature_drift(positional_slices(log)), "report")
        with runtime.lifetime(spark):
            found = runtime.kept(alerts.cooldown_alerts(log), "alerts")
        assert any(name.startswith("tidemark_run_") for name in folders(spark))
    left = folders(spark) - before
    assert {name.rsplit("-", 1)[0] for name in left} == {"report", "alerts"} and len(left) == 2
    assert sorted(map(str, report.collect())) == want and sorted(map(str, found.collect())) == fired


def test_a_failure_ends_the_lifetime(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError):
        with runtime.lifetime(spark):
            runtime.stored(spark.range(5), "some-rows")
            1 / 0
    assert folders(spark) == before
    # Outside, tables stay.
    assert runtime.stored(spark.range(5), "some-rows").count() == 5 and len(folders(spark) - before) == 1


def test_unused_names(spark):
    frame = spark.createDataFrame([(1, 2)], "Mark int, mark_ int")
    assert runtime.unused_names(frame, "mark", "mark", "other") == ["mark__", "mark___", "other"]


def test_bucketed_rows_are_dropped(spark):
    names = lambda: {t.name for t in spark.catalog.listTables()}
    before = names()
    with runtime.bucketed(spark.range(50).withColumn("k", F.col("id") % 5), "k") as rows:
        counted = rows.groupBy("k").count()
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert counted.count() == 5
    assert names() == before
