"""The keyed store, windows kept by batches, and rows that come too late."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import timetravel
from tidemark.runtime import scratch_path
from tidemark.schemas import FEATURE_LOG
from tidemark.sinks.keyed import KeyedStore
from tidemark.streaming import feeds, windows

START = datetime(2024, 1, 1)
LATEST = "entity_id string, feature_name string, value double, event_timestamp timestamp, created_at timestamp"


def store_of(spark, **sizes):
    path = scratch_path(spark, "store")
    return KeyedStore(spark, path, LATEST, ("entity_id", "feature_name"), timetravel.latest_values, **sizes)


def rows_of(spark, batch, n=6):
    rows = [(f"e{(batch * 3 + i) % 9}", "f", float(batch * 100 + i), START + timedelta(minutes=(batch * 7 + i * 5) % 60), START + timedelta(seconds=batch * 100 + i)) for i in range(n)]
    return spark.createDataFrame(rows, FEATURE_LOG)


def test_store_equals_the_log_at_a_bounded_number_of_runs(spark):
    store = store_of(spark, buckets=3, fan=2, levels=2, kept=3)
    assert store.read().count() == 0 and store.pointer().version == 0
    log, earlier = None, None
    for batch in range(11):
        rows = rows_of(spark, batch)
        log = rows if log is None else log.unionByName(rows)
        assert store.apply(rows, batch)
        assert len(store.pointer().runs) <= 2 * 2
        if batch == 8:
            earlier, want_then = store.read(), sorted(timetravel.latest_values(log).collect())
    want = timetravel.latest_values(log)
    assert sorted(store.read().collect()) == sorted(want.collect())
    # A reader that began before goes on with its version.
    assert sorted(earlier.collect()) == want_then
    # A replay changes nothing.
    before = store.pointer()
    assert not store.apply(rows_of(spark, 99), 10) and not store.apply(rows_of(spark, 99), 3) and store.pointer() == before
    asked = spark.createDataFrame([("e1", "f"), ("e8", "f"), ("nobody", "f"), (None, "f")], "entity_id string, feature_name string")
    assert sorted(store.lookup(asked).collect()) == sorted(want.filter("entity_id in ('e1', 'e8')").collect())


def test_a_broken_write_leaves_the_old_version(spark, monkeypatch):
    store = store_of(spark, buckets=2, fan=2, levels=2, kept=2)
    store.apply(rows_of(spark, 0), 0)
    before, rows = store.pointer(), sorted(store.read().collect())

    def fail(self, pointer):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyedStore, "_publish", fail)
        for _ in range(5):
            with pytest.raises(OSError):
                store.apply(rows_of(spark, 1), 1)
    assert store.pointer() == before and sorted(store.read().collect()) == rows
    assert store.apply(rows_of(spark, 1), 1)
    assert sorted(store.read().collect()) == sorted(timetravel.latest_values(rows_of(spark, 0).unionByName(rows_of(spark, 1))).collect())


def test_empty_batches_and_facts(spark):
    store = store_of(spark, fan=2, levels=2)
    for batch in range(4):
        assert store.apply(rows_of(spark, 0, n=0), batch, mark=batch * 10)
    assert store.read().count() == 0 and store.pointer().facts == {"mark": 30} and store.pointer().batch == 3


EVENT = "feature_name string, value double, event_timestamp timestamp"
EDGES = [0.0, 10.0]


def write_parts(spark, path, parts):
    for rows in parts:
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)


def plain(rows):
    return {(r.window_start, r.feature_name): (r.n, r.mean, r.variance, r.low, r.high, tuple(r.bins)) for r in rows.collect()}


def assert_same(kept, counted):
    got, want = plain(windows.statistics(kept)), plain(windows.statistics(counted))
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key][0] == row[0] and got[key][3:] == row[3:] and got[key][1:3] == pytest.approx(row[1:3])


def test_late_rows_are_marked_and_added_once(spark):
    source, offline, path, check = (scratch_path(spark, n) for n in ("events", "offline", "windows", "check"))
    at = lambda hours, value, name="f": (name, value, START + timedelta(hours=hours))
    parts = [
        [at(0.1, 1.0), at(0.2, 5.0), at(1.5, -3.0), at(0.3, None), ("f", 2.0, None)],
        [at(5.0, 11.0), at(0.4, 7.0)],  # the watermark is 0.5: hour 0 is open
        [at(0.5, 100.0), at(3.9, 4.0), at(4.5, 20.0)],  # the watermark is 4: hours 0 to 3 have ended
        [at(0.6, 50.0, "g"), at(9.0, 1.0)],
    ]
    write_parts(spark, source, parts)
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source)
    windows.windowed_write(stream, offline, path, check, "1 hour", EDGES, trigger=None).awaitTermination()
    log = spark.read.parquet(offline)
    assert sorted((r.value, r.batch) for r in log.filter("late").collect()) == [(4.0, 2), (50.0, 3), (100.0, 2)]
    assert log.count() == sum(map(len, parts))
    store = windows.window_store(spark, path)
    timed = log.filter("event_timestamp is not null")
    assert_same(store.read(), windows.window_states(timed.filter("not late"), EDGES))
    for _ in range(2):
        windows.add_late_rows(spark, offline, path, EDGES)
        assert_same(store.read(), windows.window_states(timed, EDGES))


def test_a_batch_tried_again_meets_the_same_watermark(spark, monkeypatch):
    source, offline, path, check = (scratch_path(spark, n) for n in ("events", "offline", "windows", "check"))
    write_parts(spark, source, [[("f", 1.0, START)], [("f", 2.0, START + timedelta(hours=9)), ("f", 3.0, START)], [("f", 4.0, START)]])
    stream = lambda: spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source)
    publish, calls = KeyedStore._publish, []

    def lost(self, pointer):
        calls.append(pointer.batch)
        if len(calls) == 2:
            raise OSError("lost")
        publish(self, pointer)
        if len(calls) == 4:
            raise OSError("lost after it was published")

    monkeypatch.setattr(KeyedStore, "_publish", lost)
    for _ in range(2):
        with pytest.raises(Exception):
            windows.windowed_write(stream(), offline, path, check, "1 hour", EDGES, trigger=None).awaitTermination()
    windows.windowed_write(stream(), offline, path, check, "1 hour", EDGES, trigger=None).awaitTermination()
    assert calls == [0, 1, 1, 2]
    assert sorted((r.value, r.late) for r in spark.read.parquet(offline).collect()) == [(1.0, False), (2.0, False), (3.0, False), (4.0, True)]
    assert sorted((r.n, r.mean) for r in windows.window_store(spark, path).read().collect()) == [(1, 2.0), (2, 2.0)]


def test_dual_write_keeps_few_runs(spark):
    store = feeds.online_store(spark, scratch_path(spark, "online"))
    for batch in range(9):
        store.apply(rows_of(spark, batch), batch)
    assert len(store.pointer().runs) <= 6
