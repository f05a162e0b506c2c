import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, buckets, drift, features, lineage, slices, timetravel
from tidemark.plans import graph, upkeep
from tidemark.runtime import scratch_path
from tidemark.schemas import FEATURE_LOG, MODEL_LOG
from tidemark.sinks import days, pointer, writers
from tidemark.sources import files, messages, tables

START = datetime(2024, 1, 1)
SCHEMA = "entity_id string, feature_name string, value double, event_timestamp timestamp, created_at timestamp"


def at(minutes):
    return START + timedelta(minutes=minutes)


def log_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# --- latest and point in time --------------------------------------------------------------


def test_late_arrival_does_not_replace_a_newer_value(spark):
    rows = [("e", "f", 1.0, at(10), at(10)), ("e", "f", 2.0, at(5), at(90)), ("e", "g", 3.0, at(1), None)]
    got = {r.feature_name: r for r in timetravel.latest_values(log_of(spark, rows)).collect()}
    assert got["f"].value == 1.0 and got["f"].created_at == at(10)
    assert got["g"].value == 3.0 and got["g"].created_at is None


def test_a_correction_known_later_wins_at_equal_event_time(spark):
    rows = [("e", "f", 1.0, at(10), at(11)), ("e", "f", 2.0, at(10), at(30)), ("e", "f", 3.0, at(10), None)]
    assert timetravel.latest_values(log_of(spark, rows)).first().value == 2.0


def brute_pit(labels, rows, bitemporal, max_age):
    found = {}
    for label_id, entity, feature, when in labels:
        fits = [
            r
            for r in rows
            if r[0] == entity and r[1] == feature and r[3] <= when and (not bitemporal or r[4] <= when)
        ]
        best = max(fits, key=lambda r: (r[3], r[4]), default=None)
        if best and max_age and best[3] < when - max_age:
            best = None
        found[label_id] = best[2] if best else None
    return found


@pytest.fixture(params=[False, True], ids=["whole", "split"])
def ranges(request, spark):
    """Small tables in one range, or in many, so that a key lies in several."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    if request.param:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("bitemporal", [False, True])
def test_pit_join_equals_brute_force(spark, ranges, bitemporal):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        when = at(rng.randrange(6000))
        rows.append((f"e{rng.randrange(4)}", rng.choice("fg"), float(i), when, when + timedelta(minutes=rng.randrange(-60, 900))))
    labels = [(i, f"e{rng.randrange(5)}", rng.choice("fg"), at(rng.randrange(6500))) for i in range(120)]
    frame = spark.createDataFrame(
        labels, "label_id int, entity_id string, feature_name string, label_time timestamp"
    )
    age = timedelta(hours=12)
    got = timetravel.pit_join(
        frame, log_of(spark, rows), bitemporal=bitemporal, max_age=F.expr("INTERVAL 12 HOURS")
    )
    assert {r.label_id: r.value for r in got.collect()} == brute_pit(labels, rows, bitemporal, age)

    wide = timetravel.training_set(
        frame.drop("feature_name"), log_of(spark, rows), ["f", "g"], bitemporal=bitemporal
    )
    as_asked = {
        name: brute_pit([(i, e, name, t) for i, e, _, t in labels], rows, bitemporal, None) for name in "fg"
    }
    for row in wide.collect():
        assert (row.f, row.g) == (as_asked["f"][row.label_id], as_asked["g"][row.label_id])


@pytest.mark.parametrize("bitemporal", [False, True])
def test_one_key_in_one_second(spark, ranges, bitemporal):
    """A third of the log is one key in one second; null keys and times match nothing; ties go by value."""
    rng = random.Random(8)
    micro = lambda n: START + timedelta(microseconds=n)
    rows = [("hot", "f", float(i), micro(rng.randrange(1_000_000)), micro(rng.randrange(1_200_000))) for i in range(400)]
    rows += [("hot", "f", float(v), micro(500_000), micro(500_000)) for v in (3, 9, 5)]
    rows += [(f"e{i % 40}", rng.choice("fg"), float(i), micro(rng.randrange(1_000_000)), micro(10)) for i in range(300)]
    rows += [(None, "f", 1.0, micro(1), micro(1)), ("hot", None, 2.0, micro(1), micro(1)), ("hot", "f", 7.0, None, micro(1))]
    labels = [(i, "hot", "f", micro(rng.randrange(1_000_000))) for i in range(150)] + [(200, "hot", "f", micro(500_000))]
    labels += [(300 + i, f"e{i}", "f", micro(rng.randrange(1_000_000))) for i in range(45)]
    nulls = [(400, None, "f", micro(5)), (401, "hot", None, micro(5)), (402, "hot", "f", None), (403, "hot", "f", micro(0)), (403, "hot", "f", micro(0))]
    frame = spark.createDataFrame(labels + nulls, "label_id int, entity_id string, feature_name string, label_time timestamp")
    frame = frame.withColumn("tags", F.create_map(F.lit("a"), F.col("label_id"))).withColumn("match", F.lit("x"))

    def best(entity, feature, when):
        fits = [r for r in rows if None not in (entity, feature, when, r[3]) and r[:2] == (entity, feature) and r[3] <= when and (not bitemporal or r[4] <= when)]
        return max(fits, key=lambda r: (r[3], r[4], r[2]))[2] if fits else None

    got = timetravel.pit_join(frame, log_of(spark, rows), bitemporal=bitemporal).collect()
    assert len(got) == len(labels) + len(nulls) and got[0].match == "x"
    assert all(r.value == best(r.entity_id, r.feature_name, r.label_time) for r in got)
    wide = timetravel.training_set(frame.drop("feature_name"), log_of(spark, rows), ["g", "f", "none"], bitemporal=bitemporal).collect()
    assert len(wide) == len(got) and wide[0].tags
    assert all((r.f, r.g, r.none) == (best(r.entity_id, "f", r.label_time), best(r.entity_id, "g", r.label_time), None) for r in wide)


def test_a_training_set_of_many_features(spark, ranges):
    rows = [(f"e{i % 3}", f"f{i % 500}", float(i), at(i), at(i)) for i in range(3000)] + [("e1", "f7", None, at(5000), at(5000)), ("e2", "f8", float("nan"), at(5000), None)]
    labels = spark.createDataFrame([("e1", at(1500)), ("e1", at(6000)), ("e2", at(6000)), (None, at(6000))], "entity_id string, label_time timestamp")
    names = [f"f{i}" for i in range(500)]
    for row in timetravel.training_set(labels, log_of(spark, rows), names).collect():
        last = {}
        for entity, name, value, when, _ in rows:
            if entity == row.entity_id and when <= row.label_time:
                last[name] = value
        assert [row[name] for name in names] == pytest.approx([last.get(name) for name in names], nan_ok=True)


def test_label_at_the_feature_time_sees_it_and_never_the_future(spark):
    rows = [("e", "f", 1.0, at(10), at(10)), ("e", "f", 2.0, at(11), at(11))]
    labels = spark.createDataFrame(
        [("e", "f", at(10)), ("e", "f", at(9))], "entity_id string, feature_name string, label_time timestamp"
    )
    got = {r.label_time: r for r in timetravel.pit_join(labels, log_of(spark, rows)).collect()}
    assert got[at(10)].value == 1.0 and got[at(9)].value is None


def test_hydrate_and_vector(spark):
    latest = log_of(spark, [("e", "f", 1.0, at(1), at(1)), ("e", "g", 2.0, at(1), at(1))])
    asks = spark.createDataFrame(
        [(1, "e", ["g", "x"]), (2, "nobody", ["f"])], "request_id int, entity_id string, feature_names array<string>"
    )
    got = {(r.request_id, r["index"], r.feature_name): r.value for r in timetravel.hydrate(asks, latest).collect()}
    assert got == {(1, 0, "g"): 2.0, (1, 1, "x"): None, (2, 0, "f"): None}
    vector = features.entity_vector(latest, [(1, "f"), (0, "g"), (2, "h")])
    assert vector.columns == ["entity_id", "g", "f", "h"]
    assert tuple(vector.first()) == ("e", 2.0, 1.0, None)


# --- alerts --------------------------------------------------------------------------------


def brute_cooldown(moments, pause):
    fired = []
    for key in sorted({k for k, _ in moments}):
        last = None
        for t in sorted({t for k, t in moments if k == key}):
            if last is None or t > last + pause:
                fired.append((key, t))
                last = t
    return fired


def test_cooldown_equals_one_walk(spark, ranges):
    rng = random.Random(7)
    moments = [("dense", at(i)) for i in range(0, 400)]
    moments += [("sparse", at(rng.randrange(20_000))) for _ in range(60)]
    moments += [("bursts", at(rng.choice([0, 300, 305, 1000]) + rng.random() * 20)) for _ in range(200)]
    frame = spark.createDataFrame([*moments, ("dense", at(3)), (None, at(1)), ("x", None)], "entity_id string, event_timestamp timestamp")
    got = alerts.cooldown_alerts(frame)
    assert sorted(tuple(r) for r in got.collect()) == brute_cooldown(moments, timedelta(minutes=10))
    assert alerts.cooldown_alerts(frame.limit(0)).count() == 0


def test_cooldown_is_strict(spark):
    moments = [("e", at(m)) for m in (0, 5, 10, 10.001)]
    frame = spark.createDataFrame(moments, "entity_id string, event_timestamp timestamp")
    assert sorted(r.alert_time for r in alerts.cooldown_alerts(frame).collect()) == [at(0), at(10.001)]


def test_threshold_is_strict_and_three_sigma_flags_the_outlier(spark):
    rows = [(f"e{i}", "f", 100.0, at(i), at(i)) for i in range(30)] + [("x", "f", 101.0, at(40), at(40))]
    log = log_of(spark, rows)
    assert [r.entity_id for r in alerts.threshold_candidates(log).collect()] == ["x"]
    assert [r.entity_id for r in alerts.three_sigma(log).collect()] == ["x"]


# --- quality and derived features ----------------------------------------------------------


def test_statistics_of_one_and_of_no_number(spark):
    frame = spark.createDataFrame(
        [("a", "4"), ("a", "abc"), ("b", "NaN"), ("b", None)], "feature_name string, value string"
    )
    got = {r.feature_name: r for r in features.basic_statistics(frame).collect()}
    assert (got["a"].n, got["a"].mean, got["a"].variance) == (1, 4.0, None)
    assert (got["b"].n, got["b"].mean, got["b"].variance, got["b"].std) == (0, 0.0, 0.0, 0.0)
    rates = {r.feature_name: r for r in features.null_rates(frame).collect()}
    assert (rates["b"].null_rate, rates["b"].unusable_rate) == (0.5, 1.0)


def test_trailing_interval_is_strict(spark):
    log = log_of(spark, [("e", "f", float(m), at(m), at(m)) for m in (0, 1, 60)])
    assert sorted(r.value for r in features.trailing_interval(log, F.expr("INTERVAL 59 MINUTES")).collect()) == [60.0]
    assert features.trailing_interval(log, F.expr("INTERVAL 60 MINUTES")).count() == 2


def test_trailing_counts_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), "f", at(rng.randrange(0, 6000, 20))) for i in range(250)]
    frame = spark.createDataFrame(
        rows, "event_id int, entity_id string, feature_name string, event_timestamp timestamp"
    )
    got = {r.event_id: r.trailing_count for r in features.trailing_counts(frame, 2).collect()}
    for i, entity, _, when in rows:
        wanted = sum(1 for _, e, _, t in rows if e == entity and when - timedelta(days=2) <= t <= when)
        assert got[i] == wanted


    finer = features.trailing_counts(frame, 2, bucket="minute")
    assert {r.event_id: r.trailing_count for r in finer.collect()} == got


def test_the_time_unit_follows_the_densest_key(spark):
    rows = [("a", at(i / 100)) for i in range(200)] + [("b", at(i * 1440)) for i in range(5)]
    frame = spark.createDataFrame(rows, "k string, t timestamp")
    chosen = [buckets.fitting_unit(frame, ["k"], "t", limit) for limit in (1000, 199, 120, 3, 1)]
    assert chosen == ["day", "minute", "minute", "second", "second"]


def test_pages_in_time_order(spark):
    rows = [("e", "f", float(i), at(i // 2), at(i)) for i in range(40)] + [("e", "g", 1.0, at(0), at(0))]
    log = log_of(spark, rows)
    for box in (2, 1000):
        page = slices.events_in_order(log, "f", 11, 6, small_box=box)
        assert [r.value for r in page.collect()] == [11.0, 12.0, 13.0, 14.0, 15.0, 16.0]
        tail = slices.events_in_order(log, "f", 38, 10, small_box=box)
        assert [r.value for r in tail.collect()] == [38.0, 39.0]
        assert slices.events_in_order(log, "f", 50, 10, small_box=box).count() == 0


def test_lineage_ends_on_cycles(spark):
    edges = spark.createDataFrame(
        [("c", "b"), ("b", "a"), ("a", "c"), ("d", "c")], "output string, input string"
    )
    got = {(r.output, r.input): r.depth for r in lineage.dependency_closure(edges).collect()}
    assert got["d", "c"] == 1 and got["d", "b"] == 2 and got["d", "a"] == 3
    assert got["a", "a"] == 3 and len(got) == 12


def test_backfill_clears_days_without_derived_rows(spark):
    rows = [(i, "e", "f", float(i), START + timedelta(days=i), START) for i in (0, 1, 3)]
    log = spark.createDataFrame(rows, "event_id int, " + SCHEMA)
    table = days.DayTable(spark, scratch_path(spark, "derived"), "event_id int, " + SCHEMA)
    faulty = [(9, "e", name, -1.0, START + timedelta(days=day), START) for name in ("f_3d", "old one") for day in (0, 1, 2, 3)]
    table.append(spark.createDataFrame(faulty, "event_id int, " + SCHEMA))
    for _ in range(2):
        upkeep.backfill(log, date(2024, 1, 2), date(2024, 1, 4), lambda part: upkeep.trailing_feature(part, 3), table, F.expr("INTERVAL 3 DAYS"))
        got = sorted((r.feature_name, r.event_timestamp.day, r.value) for r in table.read().collect())
        assert got == [("f_3d", 1, -1.0), ("f_3d", 2, 2.0), ("f_3d", 4, -1.0), ("old one", 1, -1.0), ("old one", 4, -1.0)]


def test_trailing_counts_on_plain_log_columns(spark):
    rows = [("e", "f", 1.0, at(0), at(0))] * 3 + [("e", "f", 2.0, at(5), at(5)), (None, "f", 1.0, at(0), at(0)), ("e", "f", 1.0, None, at(0))]
    got = features.trailing_counts(log_of(spark, rows), 1).collect()
    assert sorted((r.value, r.trailing_count or 0) for r in got) == [(1.0, 0), (1.0, 0), (1.0, 3), (1.0, 3), (1.0, 3), (2.0, 4)]


def test_backfill_replaces_only_its_days_and_can_be_repeated(spark):
    rows = [(i, "e", "f", float(i), START + timedelta(days=i), START) for i in range(10)]
    log = spark.createDataFrame(rows, "event_id int, " + SCHEMA)
    table = days.DayTable(spark, scratch_path(spark, "derived"), "event_id int, " + SCHEMA)
    assert table.read().count() == 0
    table.append(log.withColumns({"feature_name": F.lit("f_3d"), "value": F.lit(-1.0)}))
    before = table.read()
    results = []
    for _ in range(2):
        upkeep.backfill(log, date(2024, 1, 5), date(2024, 1, 8), lambda part: upkeep.trailing_feature(part, 3), table)
        results.append({r.event_id: r.value for r in table.read().collect()})
    assert results[0] == results[1] == {i: 4.0 if 4 <= i < 7 else -1.0 for i in range(10)}
    # A reader that began before sees the old days; one replacement of a range stands for all earlier ones of it.
    assert {r.value for r in before.collect()} == {-1.0}
    assert len(table._pointer().newest()["entries"]) == 2


def test_a_broken_backfill_leaves_the_old_days(spark, monkeypatch):
    table = days.DayTable(spark, scratch_path(spark, "derived"), SCHEMA)
    rows = log_of(spark, [("e", "f", 1.0, at(0), at(0)), ("e", "g", 2.0, at(0), at(0)), (None, None, 3.0, None, None)])
    table.append(rows)

    def fail(self, row):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(pointer.Pointer, "publish", fail)
        with pytest.raises(OSError):
            table.replace(rows.limit(0), date(2024, 1, 1), date(2024, 1, 2))
    assert table.read().count() == 3
    table.replace(rows.limit(0), date(2024, 1, 1), date(2024, 1, 2), ["f"])
    assert sorted(r.value for r in table.read().collect()) == [2.0, 3.0]


# --- derived features that depend on one another ---------------------------------------------


def plus(name, *inputs, look_back=0):
    """Each event's sum over the inputs, plus one."""

    def derive(rows):
        summed = rows.groupBy("entity_id", "event_timestamp").agg((F.sum("value") + 1).alias("value"), F.max("created_at").alias("created_at"))
        return summed.withColumn("feature_name", F.lit(name)).select("entity_id", "feature_name", "value", "event_timestamp", "created_at")

    return graph.Step(name, inputs, derive, look_back)


DIAMOND = [plus("d", "b", "c"), plus("c", "a"), plus("b", "a", look_back=1), plus("e", "other")]


def test_layers_and_days_of_a_diamond():
    assert [sorted(s.output for s in layer) for layer in graph.layers(DIAMOND)] == [["b", "c", "e"], ["d"]]
    first, until = date(2024, 1, 3), date(2024, 1, 4)
    assert graph.touched(DIAMOND, {"a": (first, until)}) == {"b": (first, date(2024, 1, 5)), "c": (first, until), "d": (first, date(2024, 1, 5))}
    assert graph.touched(DIAMOND, {"unknown": (first, until)}) == {}
    for cycle in ([plus("x", "y"), plus("y", "x")], [plus("x", "x")], [plus("x", "a"), plus("x", "b")]):
        with pytest.raises(ValueError):
            graph.layers(cycle)


def test_only_what_is_downstream_is_derived(spark):
    rows = [("k", "a", float(d), START + timedelta(days=d), START) for d in range(5)] + [("k", "other", 9.0, START, START)]
    table = days.DayTable(spark, scratch_path(spark, "derived"), SCHEMA)
    everything = (date(2024, 1, 1), date(2024, 1, 9))
    assert graph.recompute(log_of(spark, rows), DIAMOND, table, {"a": everything, "other": everything}) == ["c", "b", "e", "d"]
    value = lambda: {(r.feature_name, r.event_timestamp.day): r.value for r in table.read().collect()}
    assert value() == {(n, d + 1): v for d in range(5) for n, v in (("b", d + 1), ("c", d + 1), ("d", 2 * d + 3))} | {("e", 1): 10}
    corrected = [(e, n, v + 100 if n == "a" and t.day == 3 else v, t, c) for e, n, v, t, c in rows if n != "other"]
    assert graph.recompute(log_of(spark, corrected), DIAMOND, table, {"a": (date(2024, 1, 3), date(2024, 1, 4))}) == ["c", "b", "d"]
    assert (value()["d", 3], value()["d", 2], value()["d", 4], value()["e", 1]) == (207, 5, 9, 10)


# --- messages, files, writers --------------------------------------------------------------


def test_broken_messages_become_dead_letters(spark):
    good = '{"entity_id":"e","feature_name":"f","value":1.5,"validated_at":"2024-01-01T00:00:00Z","created_at":"2024-01-01T00:00:01Z","more":1}'
    texts = [
        good,
        "{",
        '"text"',
        good.replace("1.5", '"x"'),
        good.replace("2024-01-01T00:00:00Z", "soon"),
        good.replace("2024-01-01T00:00:01Z", "later"),
    ]
    parsed = messages.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [tuple(r) for r in messages.good_events(parsed).collect()] == [
        ("e", "f", 1.5, START, START + timedelta(seconds=1))
    ]
    reasons = sorted(r.error for r in messages.dead_letters(parsed).collect())
    assert reasons == ["bad creation time", "bad event time"] + ["not a JSON event"] * 3


def test_parsing_happens_once_per_message(spark):
    parsed = messages.parse_messages(spark.createDataFrame([("{}",)], "value string").repartition(2))
    plan = messages.good_events(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_folder_with_array_files_parquet_and_others(spark, tmp_path):
    event = '{"entity_id":"e%d","feature_name":"f","value":%d,"validated_at":"2024-01-01T00:00:0%dZ","created_at":"2024-01-01T00:00:00Z"}'
    (tmp_path / "a.json").write_text("[\n  " + ",\n  ".join(event % (i, i, i) for i in range(3)) + "\n]")
    (tmp_path / "b.csv").write_text("x,y\n")
    later = spark.createDataFrame(
        [("p", "f", 9.0, at(1), at(2))], "entity_id string, feature_name string, value double, validated_at timestamp, created_at timestamp"
    )
    later.select("created_at", "value", "validated_at", "feature_name", "entity_id").coalesce(1).write.parquet(
        str(tmp_path / "c")
    )
    part = next((tmp_path / "c").glob("*.parquet"))
    part.rename(tmp_path / "c.parquet")
    rows = files.read_event_folder(spark, str(tmp_path))
    got = {r.entity_id: (r.value, r.event_timestamp) for r in rows.collect()}
    assert got["e2"] == (2.0, START + timedelta(seconds=2)) and got["p"] == (9.0, at(1)) and len(got) == 4
    refused = [r.path.rsplit("/", 1)[1] for r in files.rejected_files(spark, str(tmp_path)).collect()]
    assert "b.csv" in refused and not any(name.endswith((".json", ".parquet")) for name in refused)


def test_envelopes_with_missing_extra_and_bad_fields(spark):
    texts = [
        '{"table":"features_table","data":{"entity_id":"e","value":2,"event_timestamp":"2024-01-01T00:00:00Z","other":1}}',
        '{"table":"features_table","data":{"entity_id":"e","value":"abc"}}',
        '{"table":"unknown","data":{}}',
        "nothing",
    ]
    path, schemas = scratch_path(spark, "routed"), {"features_table": FEATURE_LOG, "model_logs": MODEL_LOG}
    for _ in range(2):
        writers.route_envelopes(spark.createDataFrame([(t,) for t in texts], "message string"), schemas, path, mode="overwrite")
    assert [tuple(r) for r in writers.routed(spark, schemas, path, "features_table").collect()] == [("e", None, 2.0, START, None)]
    assert writers.routed(spark, schemas, path, "model_logs").columns == MODEL_LOG.names
    refused = {r.error: r.message for r in writers.refused(spark, schemas, path).collect()}
    assert refused == {"bad value": texts[1], "unknown table unknown": texts[2], "no table": "nothing"}


def test_offline_log_prunes_partitions(spark):
    path = scratch_path(spark, "offline")
    writers.append_offline(log_of(spark, [("e", n, 1.0, at(d * 1440), at(0)) for n in "fg" for d in range(3)]), path)
    one = features.of_feature(spark.read.parquet(path), "f")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "feature_name" in plan.split("PartitionFilters")[1].split("]")[0]
    assert one.count() == 3


def test_ad_hoc_sql_returns_errors(spark):
    rows, error = tables.query_as_json(spark, "SELECT 1 AS a, 'x' AS b")
    assert rows.first().row == '{"a":1,"b":"x"}' and error == ""
    rows, error = tables.query_as_json(spark, "SELECT nothing FROM nowhere")
    assert rows is None and "nowhere" in error


def test_trailing_scan_takes_any_format(spark):
    path = scratch_path(spark, "external")
    log_of(spark, [("e", "f", float(m), at(m), at(m)) for m in range(5)]).write.parquet(path)
    hour = F.expr("INTERVAL 2 MINUTES")
    recent = tables.trailing_scan(spark, "parquet", {"path": path}, hour, F.lit(at(4)), ["value", "event_timestamp"])
    assert sorted(r.value for r in recent.collect()) == [3.0, 4.0]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(event_timestamp" in plan and "entity_id" not in plan
    options = tables.parallel_read_options("jdbc:x", "log", "event_timestamp", "a", "b", 64)
    assert options["numPartitions"] == "64" and options["partitionColumn"] == "event_timestamp"


def test_a_parquet_file_is_inserted_by_column_name(spark):
    upload, place = scratch_path(spark, "upload"), scratch_path(spark, "table")
    rows = log_of(spark, [("e", "f", 1.0, at(1), at(2))])
    rows.select(*reversed(rows.columns)).write.parquet(upload)
    spark.sql("DROP TABLE IF EXISTS inserted_log")
    spark.sql(f"CREATE TABLE inserted_log ({SCHEMA}) USING parquet LOCATION '{place}'")
    files.insert_from_file(spark, "inserted_log", upload)
    assert tuple(spark.table("inserted_log").first()) == ("e", "f", 1.0, at(1), at(2))
    spark.sql("DROP TABLE inserted_log")


def test_published_files_are_replaced(spark):
    path = scratch_path(spark, "published")
    for value in ("old", "new"):
        writers.publish(spark.createDataFrame([("k", value)], "key string, value string"), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("k", "new")]
    saved = scratch_path(spark, "baseline")
    log = log_of(spark, [("e", "f", float(v), at(v), at(v)) for v in range(11)])
    writers.save_baseline(drift.baseline_statistics(log), saved)
    read = spark.read.schema("feature_name string, n bigint, bins array<bigint>").json(saved).first()
    assert (read.feature_name, read.n, read.bins) == ("f", 11, [1] * 9 + [2])


def test_validation_reasons(spark):
    rows = [("e", "f", "1"), ("", "f", "1"), ("e", None, "1"), ("e", "x", "1"), ("e", "f", "NaN")]
    events = spark.createDataFrame(rows, "entity_id string, feature_name string, value string")
    known = spark.createDataFrame([("f",)], "feature_name string")
    got = sorted(str(r.reason) for r in features.validate(events, known).collect())
    assert got == ["None", "missing entity", "missing feature", "unknown feature", "value is no number"]
