import math

import pytest

from pyspark.sql import functions as F

from tidemark.functions import coercion, stats, text, traffic, versions


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_finite_double_drops_text_and_nan(spark):
    got = values(
        spark, [("1.5",), ("abc",), ("NaN",), (None,), ("1e3",)], "v string", stats.finite_double(F.col("v"))
    )
    assert [g[0] for g in got] == [1.5, None, None, None, 1000.0]


def test_bins_close_left_and_last_bin_holds_the_maximum(spark):
    rows = [(v, 0.0, 10.0) for v in (0.0, 0.999, 1.0, 9.0, 9.99, 10.0)]
    got = values(
        spark,
        rows,
        "v double, lo double, hi double",
        stats.equal_width_bin(F.col("v"), F.col("lo"), F.col("hi")),
    )
    assert [g[0] for g in got] == [0, 0, 1, 9, 9, 9]


def test_p_value_matches_the_series(spark):
    got = values(
        spark,
        [(0.0, 10, 10), (1.0, 50, 50), (0.2, 40, 60), (1e-3, 2, 2), (0.005, 20000, 20000), (0.008276, 20000, 20000)],
        "d double, n bigint, m bigint",
        stats.ks_pvalue(F.col("d"), F.col("n"), F.col("m")),
    )
    t = 0.2 * math.sqrt(40 * 60 / 100)
    wanted = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 101))
    assert got[0][0] == 1.0
    assert got[1][0] < 1e-20
    assert abs(got[2][0] - wanted) < 1e-12
    # Tabulated: K(0.5) = 0.036055, K(0.8276) = 0.4999
    assert got[3][0] == 1.0
    assert got[4][0] == pytest.approx(1 - 0.036055, abs=1e-5)
    assert got[5][0] == pytest.approx(0.5, abs=1e-3)


def test_status_rules_are_strict(spark):
    rows = [(0.26, 1.0, 0.0), (0.25, 1.0, 0.0), (0.1, 0.04, 0.11), (0.1, 0.05, 0.5), (0.0, 0.01, 0.1)]
    got = values(
        spark,
        rows,
        "psi double, p double, d double",
        stats.drift_status(F.col("psi"), F.col("p"), F.col("d")),
    )
    assert [g[0] for g in got] == ["CRITICAL", "WARNING", "WARNING", "PASS", "PASS"]


def test_patch_increment(spark):
    rows = [("0.1.9",), ("1.0",), ("1.x.3",), (None,), ("2.3.4.5",)]
    got = values(spark, rows, "v string", versions.next_patch(F.col("v")))
    assert [g[0] for g in got] == ["0.1.10", None, "1.0.4", None, None]


def test_declared_inputs_fall_back_to_zero_or_stay_text(spark):
    rows = [("7", "int"), ("7.5", "Integer"), ("1e5", "float"), ("abc", "double"), (" x ", "text"), (None, "int")]
    got = values(
        spark, rows, "raw string, kind string", coercion.declared_input(F.col("raw"), F.col("kind"))
    )
    assert [tuple(g[0]) for g in got] == [
        (7, None, None),
        (0, None, None),
        (None, 100000.0, None),
        (None, 0.0, None),
        (None, None, "x"),
        (0, None, None),
    ]


def test_guessed_kinds(spark):
    rows = [("7",), ("7.5",), ("1e5",), ("abc",), ("1.2.3",), ("",)]
    got = values(spark, rows, "raw string", coercion.guessed_kind(F.col("raw")))
    assert [g[0] for g in got] == ["whole", "real", "real", "text", "text", "text"]


def test_rfc3339(spark):
    rows = [("2024-01-01T00:00:00Z",), ("2024-01-01T02:00:00.250+02:00",), ("2024-01-01",), ("soon",)]
    got = values(
        spark, rows, "t string", F.date_format(text.rfc3339(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSS")
    )
    assert [g[0] for g in got] == ["2024-01-01 00:00:00.000", "2024-01-01 00:00:00.250", None, None]


def test_file_names(spark):
    rows = [("Model_A/Model_A_Production.pkl",), ("Model_A/a_Production_Production.json",), ("x/readme",)]
    got = values(
        spark,
        rows,
        "p string",
        text.is_production_file(F.col("p")),
        text.file_extension(F.col("p")),
        text.archive_file(F.col("p"), F.lit(7)),
    )
    assert got == [
        (True, "pkl", "Model_A/Model_A_7.pkl"),
        (True, "json", "Model_A/a_7_Production.json"),
        (False, "", "x/readme"),
    ]


def test_json_forms(spark):
    frame = spark.sql("SELECT map('b', '2', 'a', '1') AS m, 1.5D AS v, timestamp'2024-01-02 03:04:05' AS t")
    row = frame.select(
        text.sorted_map_json(F.col("m")), text.result_text(F.col("v")), text.online_value(F.col("v"), F.col("t"))
    ).first()
    assert row[0] == '{"a":"1","b":"2"}'
    assert row[1] == "1.500000"
    assert row[2] == '{"val":1.5,"timestamp":"2024-01-02T03:04:05.000000Z"}'


def test_traffic_bucket_is_fixed(spark):
    assert spark.range(1).select(traffic.traffic_bucket(F.lit("user_8"))).first()[0] == 28
