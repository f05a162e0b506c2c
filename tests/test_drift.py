import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import distribution, drift, selection, sketch
from tidemark.operators.slices import numeric_values, period_slices, positional_slices
from tidemark.suite import base

START = datetime(2024, 1, 1)


def log_of(spark, rows):
    return spark.createDataFrame(
        rows,
        "entity_id string, feature_name string, value double, event_timestamp timestamp, created_at timestamp",
    )


def plain_slices(rows):
    """Slices by sorting, as (feature, slice) -> sorted values."""
    result = {}
    for feature in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == feature), key=lambda r: (r[3], r[4]))
        n = len(own)
        first, end, start, stop = int(n * 0.5), int(n * 0.7), int(n * 0.95), n
        result[feature, "historical"] = sorted(r[2] for r in own[first:end])
        result[feature, "current"] = sorted(r[2] for r in own[start:stop])
    return {k: v for k, v in result.items() if v}


def sliced(frame):
    found = {}
    for row in frame.collect():
        found.setdefault((row.feature_name, row.slice), []).append(row.value)
    return {k: sorted(v) for k, v in found.items()}


def random_rows(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for feature, n in sizes.items():
        for i in range(n):
            at = START + timedelta(seconds=rng.randrange(10**6), microseconds=rng.randrange(10**6))
            rows.append((f"e{i}", feature, round(rng.gauss(0, 1), 3), at, at))
    return rows


@pytest.mark.parametrize("small_box", [1, 7, 100_000])
def test_slices_equal_a_plain_sort(spark, small_box):
    rows = random_rows(1, {"a": 500, "b": 41, "c": 1, "d": 2})
    got = sliced(positional_slices(log_of(spark, rows), small_box=small_box))
    assert got == plain_slices(rows)


@pytest.mark.parametrize("small_box", [3, 100_000])
def test_slices_with_one_event_time_fall_back_to_knowledge_time(spark, small_box):
    rows = [(f"e{i}", "a", float(i), START, START + timedelta(minutes=i)) for i in range(100)]
    got = sliced(positional_slices(log_of(spark, rows), small_box=small_box))
    assert got == plain_slices(rows)


@pytest.mark.parametrize("small_box", [3, 100_000])
def test_slices_of_identical_rows_keep_their_size(spark, small_box):
    rows = [("e", "a", 1.0, START, START)] * 100
    got = sliced(positional_slices(log_of(spark, rows), small_box=small_box))
    assert {k: len(v) for k, v in got.items()} == {("a", "historical"): 20, ("a", "current"): 5}


def slices_of(spark, hist, curr, feature="f"):
    rows = [(feature, "historical", float(v)) for v in hist] + [(feature, "current", float(v)) for v in curr]
    return spark.createDataFrame(rows, "feature_name string, slice string, value double")


def numpy_metrics(hist, curr):
    hist, curr = np.sort(np.array(hist, float)), np.sort(np.array(curr, float))
    points = np.concatenate([hist, curr])
    d = np.max(
        np.abs(
            np.searchsorted(hist, points, "right") / len(hist)
            - np.searchsorted(curr, points, "right") / len(curr)
        )
    )
    low, high = points.min(), points.max()
    if low == high:
        return d, 0.0, 0.0
    edges = np.linspace(low, high, 11)
    q, p = (np.histogram(x, bins=edges)[0] / len(x) for x in (hist, curr))
    q, p = np.where(q == 0, 1e-10, q), np.where(p == 0, 1e-10, p)
    psi = np.sum((p - q) * np.log(p / q))
    p, q = p / p.sum(), q / q.sum()
    return d, psi, np.sum(p * np.log(p / q))


CASES = {
    "normal": (np.random.default_rng(1).normal(0, 1, 400), np.random.default_rng(2).normal(0.3, 1.2, 90)),
    "heavy tail": (np.random.default_rng(3).lognormal(0, 3, 500), np.random.default_rng(4).lognormal(0.2, 3, 200)),
    "few values": (np.random.default_rng(5).integers(0, 4, 300), np.random.default_rng(6).integers(0, 5, 80)),
    "hot value": (np.r_[np.zeros(300), np.arange(50)], np.r_[np.zeros(90), np.arange(30) / 7]),
    "disjoint": (np.arange(10), np.arange(100, 110)),
    "constant": (np.full(20, 3.0), np.full(5, 3.0)),
    "identical": (np.arange(50), np.arange(50)),
    "single": (np.array([1.0]), np.array([2.0])),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("small_box", [4, 100_000])
def test_metrics_equal_numpy(spark, name, small_box):
    hist, curr = CASES[name]
    got = drift.feature_drift(slices_of(spark, hist, curr), small_box=small_box).first()
    d, psi, kl = numpy_metrics(hist, curr)
    assert math.isclose(got.ks_stat, d, abs_tol=1e-12)
    assert math.isclose(got.psi, psi, rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(got.kl_divergence, kl, rel_tol=1e-9, abs_tol=1e-12)
    assert got.psi >= 0 and got.kl_divergence >= -1e-12 and 0 <= got.ks_stat <= 1


def test_edge_cases_have_their_status(spark):
    same = drift.feature_drift(slices_of(spark, *CASES["identical"])).first()
    assert (same.ks_stat, same.ks_p_value, same.psi, same.status) == (0.0, 1.0, 0.0, "PASS")
    apart = drift.feature_drift(slices_of(spark, *CASES["disjoint"])).first()
    assert apart.ks_stat == 1.0 and apart.status == "CRITICAL"


def test_a_feature_without_one_slice_is_left_out(spark):
    both = slices_of(spark, [1, 2], [1, 3]).unionByName(slices_of(spark, [1, 2], [], "lonely"))
    assert [r.feature_name for r in drift.feature_drift(both).collect()] == ["f"]


def test_text_and_nan_are_dropped_after_slicing(spark):
    rows = [("f", "historical", v) for v in ("1", "abc", "NaN", None, "2")]
    frame = spark.createDataFrame(rows, "feature_name string, slice string, value string")
    assert sorted(r.value for r in numeric_values(frame).collect()) == [1.0, 2.0]


def test_golden_values(spark):
    log = base.feature_log(spark, "/root/testdata/sf0.01")
    got = {r.feature_name: r for r in drift.feature_drift(positional_slices(log)).collect()}
    wanted = {
        "click": (401, 101, 0.044468037826, 0.453655113050, 0.041803874759, "CRITICAL"),
        "error": (402, 101, 0.103024481553, 0.373109075865, 0.091023717388, "CRITICAL"),
        "purchase": (396, 100, 0.065858585859, 0.324642083909, 0.042443387872, "CRITICAL"),
        "signup": (403, 101, 0.087241726654, 0.100442867100, 0.045406252324, "WARNING"),
        "view": (396, 100, 0.079898989899, 0.173229134907, 0.028599009862, "WARNING"),
    }
    for feature, (n, m, d, psi, kl, status) in wanted.items():
        row = got[feature]
        assert (row.n_hist, row.n_curr, row.status) == (n, m, status)
        assert abs(row.ks_stat - d) < 1e-11
        assert abs(row.psi - psi) < 1e-11
        assert abs(row.kl_divergence - kl) < 1e-11
    assert abs(got["error"].ks_p_value - 0.3583490693737) < 1e-12


def test_period_slices_bounds(spark):
    rows = [(f"e{i}", "a", float(i), START + timedelta(days=i), START) for i in range(30)]
    got = sliced(period_slices(log_of(spark, rows), F.lit(START + timedelta(days=29))))
    assert got == {
        ("a", "current"): [float(i) for i in range(23, 30)],
        ("a", "historical"): [float(i) for i in range(16, 23)],
    }


def test_categorical_psi_and_chi_square(spark):
    rows = [("m", "historical", "x")] * 8 + [("m", "historical", "y")] * 2
    rows += [("m", "current", "x")] * 3 + [("m", "current", "z")] * 1
    frame = spark.createDataFrame(rows, "g string, slice string, c string")
    counts = drift.category_counts(frame, "g", F.col("c"))
    psi = drift.categorical_psi(counts, "g").first()
    p, q = [0.75, 1e-10, 0.25], [0.8, 0.2, 1e-10]
    assert math.isclose(psi.psi, sum((a - b) * math.log(a / b) for a, b in zip(p, q)))
    chi = drift.chi_square(counts, "g").first()
    table = np.array([[8, 2, 0], [3, 0, 1]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert math.isclose(chi.chi_square, ((table - expected) ** 2 / expected).sum())
    assert chi.degrees == 2


def test_baseline_puts_outliers_into_the_end_bins(spark):
    trained = spark.createDataFrame([("f", float(v)) for v in range(11)], "feature_name string, value double")
    live = spark.createDataFrame([("f", v) for v in (-5.0, 0.5, 99.0)], "feature_name string, value double")
    saved = drift.baseline_statistics(trained)
    assert saved.first().bins == [1] * 9 + [2]
    got = drift.baseline_drift(saved, live).first()
    p = np.array([2] + [0] * 8 + [1]) / 3
    q = np.array([1] * 9 + [2]) / 11
    p, q = np.where(p == 0, 1e-10, p), np.where(q == 0, 1e-10, q)
    assert math.isclose(got.psi, np.sum((p - q) * np.log(p / q)), rel_tol=1e-9)


@pytest.mark.parametrize("small_box", [3, 100_000])
def test_exact_percentile(spark, small_box):
    rng = np.random.default_rng(7)
    data = {"a": rng.lognormal(0, 2, 500), "b": rng.integers(0, 3, 77).astype(float), "c": np.array([5.0])}
    frame = spark.createDataFrame(
        [(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double"
    )
    for fraction in (0.0, 0.5, 0.95, 1.0):
        got = {r.g: r for r in selection.exact_percentile(frame, "g", "v", fraction, small_box).collect()}
        for g, vs in data.items():
            assert got[g].n == len(vs)
            assert math.isclose(got[g].percentile, np.quantile(vs, fraction), rel_tol=1e-12)


EXTREMES = {
    "overflow": [-1.7e308, 1.7e308, *(1.5e308 * x for x in np.linspace(-1, 1, 40))],
    "denormals": [5e-324 * i for i in range(30)] + [1.7e308, 1.0, -5e-324, 0.0],
    "ties": [1.0] * 300 + [2.0] * 300 + [np.nextafter(1.0, 2.0)] * 2 + [3.0],
    "powers": [2.0**i for i in range(-1070, 1020, 7)],
    "one": [4.0] * 50,
}


@pytest.mark.parametrize("small_box", [1, 5])
def test_ranks_of_any_doubles_are_found(spark, small_box):
    frame = spark.createDataFrame([(g, float(v)) for g, vs in EXTREMES.items() for v in vs], "g string, v double")
    for fraction in (0.5, 0.95):
        got = {r.g: r for r in selection.exact_percentile(frame, "g", "v", fraction, small_box).collect()}
        for g, vs in EXTREMES.items():
            ranked, at = sorted(vs), fraction * (len(vs) - 1)
            below, above = ranked[math.floor(at)], ranked[math.ceil(at)]
            want = (below / 2 + (above / 2 - below / 2) * (at - math.floor(at))) * 2
            assert math.isclose(got[g].percentile, want, rel_tol=1e-9, abs_tol=1e-320), g


@pytest.mark.parametrize("small_box", [1, 20])
def test_distance_of_any_doubles(spark, small_box):
    rng = np.random.default_rng(9)
    for name, vs in EXTREMES.items():
        hist, curr = rng.choice(vs, 90), np.sort(rng.choice(vs, 60))[:50]
        got = distribution.ks_distance(distribution.bin_values(slices_of(spark, hist, curr)), small_box).first()
        at = np.unique(np.concatenate([hist, curr]))
        d = np.abs(np.searchsorted(np.sort(hist), at, "right") / 90 - np.searchsorted(curr, at, "right") / 50).max()
        assert math.isclose(got.ks_stat, d, abs_tol=1e-12), name


def test_splitter_numbers_follow_the_order(spark):
    grid = sorted([*range(0, 250), *[100] * 5, 300, 400])
    keys = [-1, 0, 0.5, 99.5, 100, 100.5, 249, 250, 350, 400, 401]
    row = spark.createDataFrame([([float(g) for g in grid], float(k)) for k in keys], "grid array<double>, k double")
    numbers = [r[0] for r in row.select(selection.splitter_number(F.col("k"), F.col("grid"))).collect()]
    assert numbers == [sum(g < k for g in grid) + sum(g <= k for g in grid) for k in keys]


@pytest.mark.parametrize("small_box", [3, 100_000])
def test_seeded_sample_is_the_same_every_time(spark, small_box):
    frame = spark.range(300).select("id", F.when(F.col("id") < 280, "a").otherwise("b").alias("g"))
    drawn = selection.seeded_sample(frame, "g", F.col("id").cast("string"), 50, small_box)
    again = selection.seeded_sample(frame.repartition(5), "g", F.col("id").cast("string"), 50)
    first = sorted(r.id for r in drawn.collect())
    assert first == sorted(r.id for r in again.collect())
    assert sum(i < 280 for i in first) == 50 and sum(i >= 280 for i in first) == 20


def test_sketch_distance_is_near_the_exact_one(spark):
    hist, curr = CASES["normal"]
    slices = slices_of(spark, hist, curr)
    exact = distribution.ks_distance(distribution.bin_values(slices)).first().ks_stat
    near = sketch.sketch_distance(slices).first()
    assert (near.n_hist, near.n_curr) == (400, 90)
    assert abs(near.sketch_ks - exact) < 0.02


def test_sketch_merge_counts_all_rows_and_skips_nulls(spark):
    frame = spark.range(1000).select(
        (F.col("id") % 4).alias("part"), F.when(F.col("id") % 10 != 0, F.col("id")).alias("value")
    )
    merged = sketch.merge_sketches(sketch.sketch_by(frame, ["part"]).withColumn("g", F.lit(1)), ["g"])
    row = sketch.read_quantiles(merged, ["g"], [0.5]).first()
    assert row.n == 900 and abs(row.q50 - 500) < 40


def test_interval_analysis_of_an_empty_interval(spark):
    rows = log_of(spark, [("e", "a", 4.0, START, START), ("e", "a", 6.0, START + timedelta(hours=2), START)])
    hour = F.expr("INTERVAL 1 HOUR")
    answer = sketch.analyze_interval(rows, "value", hour).first()
    assert (answer.total_weight, answer.calculated_mean, answer.drift_detected) == (1, 6.0, False)
    later = sketch.analyze_interval(rows, "value", hour, F.lit(START + timedelta(days=9))).first()
    assert (later.analyzed_centroids, later.calculated_mean) == (0, 0.0)
    rows.createOrReplaceTempView("named_log")
    named = sketch.analyze_table(spark, "3 HOURS", "named_log", "value").first()
    assert named.calculated_mean == 5.0


def test_infinite_values_take_no_part(spark):
    rows = [(f"e{i}", "a", float(i % 7), START + timedelta(minutes=i), START) for i in range(60)]
    rows[35] = ("e35", "a", float("inf"), rows[35][3], START)
    rows[58] = ("e58", "a", float("nan"), rows[58][3], START)
    report = feature_rows(spark, rows)
    assert report.ks_stat <= 1.0 and report.psi >= 0


def feature_rows(spark, rows):
    from tidemark.operators import drift

    return drift.feature_drift(positional_slices(log_of(spark, rows), small_box=5)).first()
