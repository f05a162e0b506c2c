"""Queries on slices, distances, drift reports and baselines."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.stats import drift_status
from tidemark.operators import distribution, drift, features, registry, selection, serving, sketch
from tidemark.operators.slices import (
    numeric_values,
    period_slices,
    positional_slices,
)
from tidemark.plans import publication
from tidemark.runtime import scratch_path, stored
from tidemark.sources import tables
from tidemark.suite import base
from tidemark.suite.base import clock, feature_log, log_sql, query

# --- counts and moments ------------------------------------------------------------------


@query(
    "feature_counts",
    "SELECT event_type AS feature_name, count(*) AS n FROM events GROUP BY event_type",
)
def _(spark, sf_dir):
    return features.feature_counts(feature_log(spark, sf_dir))


@query(
    "basic_stats",
    f"""WITH {base.DIRTY_SQL}
    SELECT feature_name, count(number) AS n, round(avg(number), 6) AS mean,
           round(var_samp(number), 6) AS variance, round(stddev_samp(number), 6) AS std
    FROM dirty GROUP BY feature_name""",
)
def _(spark, sf_dir):
    stats = features.basic_statistics(base.dirty_log(spark, sf_dir))
    return stats.select(
        "feature_name", "n", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "std")]
    )


@query(
    "null_rates",
    f"""WITH {base.DIRTY_SQL}
    SELECT feature_name, count(*) AS n, round(avg(CAST(missing AS INTEGER)), 9) AS null_rate,
           round(avg(CASE WHEN number IS NULL THEN 1 ELSE 0 END), 9) AS unusable_rate
    FROM dirty GROUP BY feature_name""",
)
def _(spark, sf_dir):
    rates = features.null_rates(base.dirty_log(spark, sf_dir))
    return rates.select(
        "feature_name",
        "n",
        F.round("null_rate", 9).alias("null_rate"),
        F.round("unusable_rate", 9).alias("unusable_rate"),
    )


# --- slices ------------------------------------------------------------------------------


def ranked_sql(source: str, group: str, cap: int | None = None) -> str:
    """CTEs up to ``sliced``: the rows of both slices by plain row numbers."""
    n = "CAST(n AS DOUBLE)"
    first, end = f"floor({n} * CAST(0.5 AS DOUBLE))", f"floor({n} * CAST(0.7 AS DOUBLE))"
    start, stop = f"floor({n} * CAST(0.95 AS DOUBLE))", "n"
    if cap is not None:
        end, stop = f"least({end}, {first} + {cap})", f"least({stop}, {start} + {cap})"
    return f"""ranked AS (
      SELECT *, row_number() OVER (PARTITION BY {group}
                  ORDER BY event_timestamp, created_at, event_id) - 1 AS rn,
             count(*) OVER (PARTITION BY {group}) AS n
      FROM {source}),
    sliced AS (
      SELECT * FROM (
        SELECT *, CASE WHEN rn >= {first} AND rn < {end} THEN 'historical'
                       WHEN rn >= {start} AND rn < {stop} THEN 'current' END AS slice
        FROM ranked) WHERE slice IS NOT NULL)"""


def metrics_sql(group: str) -> str:
    """CTEs from ``sliced`` to ``metrics`` (distances and status per group)."""
    hits = " + ".join(
        f"CASE WHEN value >= low + {i} * ((high - low) / 10) THEN 1 ELSE 0 END" for i in range(1, 10)
    )
    return f"""vals AS (SELECT {group} AS g, slice, value FROM sliced WHERE value IS NOT NULL),
    totals AS (
      SELECT g, count(*) FILTER (WHERE slice = 'historical') AS n_hist,
             count(*) FILTER (WHERE slice = 'current') AS n_curr, min(value) AS low, max(value) AS high
      FROM vals GROUP BY g
      HAVING count(*) FILTER (WHERE slice = 'historical') > 0
         AND count(*) FILTER (WHERE slice = 'current') > 0),
    points AS (
      SELECT g, value, count(*) FILTER (WHERE slice = 'historical') AS h,
             count(*) FILTER (WHERE slice = 'current') AS c
      FROM vals GROUP BY g, value),
    cdf AS (
      SELECT g, CAST(sum(h) OVER (PARTITION BY g ORDER BY value) AS DOUBLE) AS h,
             CAST(sum(c) OVER (PARTITION BY g ORDER BY value) AS DOUBLE) AS c
      FROM points),
    distance AS (
      SELECT g, max(abs(h / n_hist - c / n_curr)) AS ks_stat FROM cdf JOIN totals USING (g) GROUP BY g),
    tests AS (
      SELECT *, CASE WHEN ks_stat = 0 THEN 1 WHEN t < 1 THEN greatest(0, least(1, 1 - sqrt(2 * pi()) / t * list_sum(
             [exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * t * t)) FOR k IN range(1, 21)])))
             ELSE greatest(0, least(1, 2 * list_sum(
             [(CASE WHEN k % 2 = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END)
              * exp(CAST(-2 AS DOUBLE) * k * k * t * t) FOR k IN range(1, 101)]))) END AS ks_p_value
      FROM (SELECT g, n_hist, n_curr, low, high, ks_stat,
                   ks_stat * sqrt(CAST(n_hist AS DOUBLE) * n_curr / (n_hist + n_curr)) AS t
            FROM distance JOIN totals USING (g))),
    binned AS (
      SELECT g, slice, {hits} AS bin FROM vals JOIN totals USING (g)),
    histogram AS (
      SELECT t.g, t.n_hist, t.n_curr, t.low, t.high, CAST(b.bin AS INTEGER) AS bin,
             count(*) FILTER (WHERE x.slice = 'historical') AS hist,
             count(*) FILTER (WHERE x.slice = 'current') AS curr
      FROM totals t CROSS JOIN range(10) b(bin) LEFT JOIN binned x ON x.g = t.g AND x.bin = b.bin
      GROUP BY ALL),
    shares AS (
      SELECT *, CASE WHEN curr = 0 THEN 1e-10 ELSE curr / CAST(n_curr AS DOUBLE) END AS p,
                CASE WHEN hist = 0 THEN 1e-10 ELSE hist / CAST(n_hist AS DOUBLE) END AS q
      FROM histogram),
    normed AS (
      SELECT *, p / sum(p) OVER (PARTITION BY g) AS pn, q / sum(q) OVER (PARTITION BY g) AS qn FROM shares),
    shift AS (
      SELECT g, CASE WHEN low = high THEN 0 ELSE sum((p - q) * ln(p / q)) END AS psi,
             CASE WHEN low = high THEN 0 ELSE sum(pn * ln(pn / qn)) END AS kl_divergence
      FROM normed GROUP BY g, low, high),
    metrics AS (
      SELECT t.g, t.n_hist, t.n_curr, t.ks_stat, t.ks_p_value, s.psi, s.kl_divergence,
             CASE WHEN s.psi > 0.25 THEN 'CRITICAL' WHEN s.psi > 0.1 THEN 'WARNING'
                  WHEN t.ks_p_value < 0.05 AND t.ks_stat > 0.1 THEN 'WARNING' ELSE 'PASS' END AS status
      FROM tests t JOIN shift s USING (g))"""


SLICES = f"WITH {log_sql()}, {ranked_sql('log', 'feature_name')}"
METRICS = f"{SLICES}, {metrics_sql('feature_name')}"
REPORT = """SELECT g AS {group}, n_hist, n_curr, round(ks_stat, 9) AS ks_stat,
    round(ks_p_value, 9) AS ks_p_value, round(psi, 9) AS psi,
    round(kl_divergence, 9) AS kl_divergence, status FROM metrics"""


def rounded(metrics, group="feature_name"):
    names = ("ks_stat", "ks_p_value", "psi", "kl_divergence")
    return metrics.select(
        group, "n_hist", "n_curr", *[F.round(c, 9).alias(c) for c in names], "status"
    )


def slices_of(spark, sf_dir):
    return positional_slices(feature_log(spark, sf_dir))


def binned_of(spark, sf_dir):
    return distribution.bin_values(stored(numeric_values(slices_of(spark, sf_dir)), "slices"))


def metrics_of(spark, sf_dir):
    return drift.feature_drift(slices_of(spark, sf_dir))


@query(
    "drift_slices",
    f"{SLICES} SELECT event_id, feature_name, slice, value FROM sliced",
)
def _(spark, sf_dir):
    return slices_of(spark, sf_dir).select("event_id", "feature_name", "slice", "value")


@query(
    "slice_stats",
    f"""{SLICES} SELECT feature_name, slice, count(*) AS n, round(avg(value), 6) AS mean,
        round(var_samp(value), 6) AS variance, round(stddev_samp(value), 6) AS std
    FROM sliced GROUP BY feature_name, slice""",
)
def _(spark, sf_dir):
    stats = distribution.slice_statistics(numeric_values(slices_of(spark, sf_dir)))
    return stats.select(
        "feature_name", "slice", "n", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "std")]
    )


# --- distances ---------------------------------------------------------------------------


@query(
    "ks_statistic",
    f"{METRICS} SELECT g AS feature_name, n_hist, n_curr, round(ks_stat, 9) AS ks_stat FROM metrics",
)
def _(spark, sf_dir):
    found = distribution.ks_distance(binned_of(spark, sf_dir))
    return found.select("feature_name", "n_hist", "n_curr", F.round("ks_stat", 9).alias("ks_stat"))


@query(
    "ks_pvalue",
    f"{METRICS} SELECT g AS feature_name, round(ks_p_value, 9) AS ks_p_value FROM metrics",
)
def _(spark, sf_dir):
    found = distribution.ks_distance(binned_of(spark, sf_dir))
    return found.select("feature_name", F.round("ks_p_value", 9).alias("ks_p_value"))


@query(
    "shared_histogram",
    f"{METRICS} SELECT g AS feature_name, bin, hist, curr FROM histogram",
)
def _(spark, sf_dir):
    filled = distribution.shared_histogram(binned_of(spark, sf_dir))
    return filled.select("feature_name", "bin", "hist", "curr")


@query("psi", f"{METRICS} SELECT g AS feature_name, round(psi, 9) AS psi FROM metrics")
def _(spark, sf_dir):
    filled = distribution.shared_histogram(binned_of(spark, sf_dir))
    return distribution.population_shift(filled).select(
        "feature_name", F.round("psi", 9).alias("psi")
    )


@query(
    "kl_divergence",
    f"{METRICS} SELECT g AS feature_name, round(kl_divergence, 9) AS kl_divergence FROM metrics",
)
def _(spark, sf_dir):
    filled = distribution.shared_histogram(binned_of(spark, sf_dir))
    return distribution.population_shift(filled).select(
        "feature_name", F.round("kl_divergence", 9).alias("kl_divergence")
    )


@query(
    "constant_feature",
    f"""WITH {log_sql()}, {ranked_sql('(SELECT * REPLACE (CAST(5 AS DOUBLE) AS value) FROM log)', 'feature_name')},
    {metrics_sql('feature_name')} {REPORT.format(group='feature_name')}""",
)
def _(spark, sf_dir):
    constant = feature_log(spark, sf_dir).withColumn("value", F.lit(5.0))
    return rounded(drift.feature_drift(positional_slices(constant)))


# --- reports -----------------------------------------------------------------------------


@query("drift_report", f"{METRICS} {REPORT.format(group='feature_name')}")
def drift_report(spark, sf_dir):
    return rounded(metrics_of(spark, sf_dir))


@query(
    "drift_status",
    f"{METRICS} SELECT status, count(*) AS features FROM metrics GROUP BY status",
)
def _(spark, sf_dir):
    binned = binned_of(spark, sf_dir)
    shift = distribution.population_shift(distribution.shared_histogram(binned))
    joined = distribution.ks_distance(binned).join(shift, "feature_name")
    status = drift_status(F.col("psi"), F.col("ks_p_value"), F.col("ks_stat"))
    return joined.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("features"))


@query(
    "weekly_drift",
    f"""WITH {log_sql()},
    edge AS (SELECT max(event_timestamp) AS as_of FROM log),
    sliced AS (
      SELECT * FROM (SELECT log.*, CASE
          WHEN event_timestamp > as_of - INTERVAL 7 DAYS AND event_timestamp <= as_of THEN 'current'
          WHEN event_timestamp > as_of - INTERVAL 14 DAYS AND event_timestamp <= as_of - INTERVAL 7 DAYS
          THEN 'historical' END AS slice FROM log CROSS JOIN edge) WHERE slice IS NOT NULL),
    {metrics_sql('feature_name')} {REPORT.format(group='feature_name')}""",
)
def _(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    newest = log.select(F.max("event_timestamp")).scalar()
    return rounded(drift.feature_drift(period_slices(log, newest)))


@query(
    "model_drift",
    f"""{METRICS}, {base.REGISTRY_SQL}
    SELECT f.model_id, f.version, f.feature_name, m.status, round(m.psi, 9) AS psi,
           bool_or(m.status IN ('WARNING', 'CRITICAL')) OVER (PARTITION BY f.model_id, f.version) AS drift_detected
    FROM model_features f JOIN metrics m ON m.g = f.feature_name WHERE f.status = 'production'""",
)
def _(spark, sf_dir):
    rolled = registry.model_drift(base.registry(spark, sf_dir), metrics_of(spark, sf_dir))
    flat = rolled.select("model_id", "version", "drift_detected", F.inline("feature_metrics"))
    return flat.select(
        "model_id",
        "version",
        "feature_name",
        "status",
        F.round("psi", 9).alias("psi"),
        "drift_detected",
    )


@query(
    "retrain_models",
    f"""{METRICS}, {base.REGISTRY_SQL}
    SELECT DISTINCT f.model_id, f.version FROM model_features f JOIN metrics m ON m.g = f.feature_name
    WHERE f.status = 'production' AND m.status = 'CRITICAL'""",
)
def _(spark, sf_dir):
    return registry.retrain_models(base.registry(spark, sf_dir), metrics_of(spark, sf_dir))


@query(
    "drift_score_writeback",
    f"""{METRICS}, {base.REGISTRY_SQL}
    SELECT f.model_id, f.version, CAST(f.index AS INTEGER) AS index, f.feature_name,
           round(CASE WHEN f.status = 'production' THEN coalesce(m.psi, f.model_drift_score)
                      ELSE f.model_drift_score END, 9) AS drift_score
    FROM model_features f LEFT JOIN metrics m ON m.g = f.feature_name""",
)
def _(spark, sf_dir):
    updated = registry.write_back_scores(base.registry(spark, sf_dir), metrics_of(spark, sf_dir))
    flat = updated.select("model_id", "version", F.inline("expected_features"))
    return flat.select(
        "model_id",
        "version",
        "index",
        F.col("name").alias("feature_name"),
        F.round("drift_score", 9).alias("drift_score"),
    )


@query(
    "metrics_long",
    f"""{METRICS} SELECT g AS feature_name, 'psi' AS metric, round(psi, 9) AS value FROM metrics
    UNION ALL SELECT g, 'ks_stat', round(ks_stat, 9) FROM metrics
    UNION ALL SELECT g, 'ks_p_value', round(ks_p_value, 9) FROM metrics
    UNION ALL SELECT g, 'kl_divergence', round(kl_divergence, 9) FROM metrics""",
)
def _(spark, sf_dir):
    long = drift.metrics_long(
        metrics_of(spark, sf_dir),
        ["feature_name"],
        ["psi", "ks_stat", "ks_p_value", "kl_divergence"],
    )
    return long.select("feature_name", "metric", F.round("value", 9).alias("value"))


# Two models over two slices, every run made twice.
@query(
    "metric_log",
    f"""{METRICS}, named AS (
      SELECT g AS feature_name, unnest(['psi', 'ks_stat']) AS metric, unnest([psi, ks_stat]) AS value FROM metrics)
    SELECT m.model_id, feature_name, s.slice_end, metric, round(value, 9) AS value
    FROM named, (VALUES ('m1'), ('m2')) m(model_id), (VALUES ('2024-01-30 00:00:00.000000'), ('2024-01-31 00:00:00.000000')) s(slice_end)""",
)
def _(spark, sf_dir):
    log = publication.metric_log(spark, scratch_path(spark, "metrics"))
    found = stored(drift.metrics_long(metrics_of(spark, sf_dir), ["feature_name"], ["psi", "ks_stat"]), "metrics")
    for model in ("m1", "m2"):
        for end in ("2024-01-30", "2024-01-31"):
            for _attempt in range(2):
                publication.record_metrics(log, found, model, end, f"{model}/{end}")
    return log.read().select("model_id", "feature_name", clock("slice_end").alias("slice_end"), "metric", F.round("value", 9).alias("value"))


@query(
    "prediction_drift",
    f"""WITH {base.PREDICTION_SQL},
    results AS (SELECT event_id, model_id, prediction AS value, predicted_at AS event_timestamp,
                       predicted_at AS created_at FROM predictions WHERE model_error = ''),
    {ranked_sql('results', 'model_id')}, {metrics_sql('model_id')} {REPORT.format(group='model_id')}""",
)
def _(spark, sf_dir):
    log = serving.log_rows(base.predictions(spark, sf_dir), F.col("predicted_at"))
    return rounded(
        drift.feature_drift(serving.prediction_slices(log), group="model_id"), "model_id"
    )


# --- categories and labels ---------------------------------------------------------------

_CATEGORIES = f"""WITH {log_sql()},
    edge AS (SELECT max(event_timestamp) AS as_of FROM log),
    sliced AS (
      SELECT * FROM (SELECT entity_id, feature_name AS category, CASE
          WHEN event_timestamp > as_of - INTERVAL 7 DAYS AND event_timestamp <= as_of THEN 'current'
          WHEN event_timestamp > as_of - INTERVAL 14 DAYS AND event_timestamp <= as_of - INTERVAL 7 DAYS
          THEN 'historical' END AS slice FROM log CROSS JOIN edge) WHERE slice IS NOT NULL),
    counts AS (
      SELECT entity_id, category, count(*) FILTER (WHERE slice = 'historical') AS hist,
             count(*) FILTER (WHERE slice = 'current') AS curr FROM sliced GROUP BY entity_id, category),
    totalled AS (
      SELECT * FROM (SELECT *, sum(hist) OVER (PARTITION BY entity_id) AS n_hist,
             sum(curr) OVER (PARTITION BY entity_id) AS n_curr FROM counts)
      WHERE n_hist > 0 AND n_curr > 0)"""


def _category_counts(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    newest = log.select(F.max("event_timestamp")).scalar()
    return drift.category_counts(
        period_slices(log, newest), "entity_id", F.col("feature_name")
    )


@query(
    "categorical_psi",
    f"""{_CATEGORIES},
    shares AS (
      SELECT *, CASE WHEN curr = 0 THEN 1e-10 ELSE curr / CAST(n_curr AS DOUBLE) END AS p,
                CASE WHEN hist = 0 THEN 1e-10 ELSE hist / CAST(n_hist AS DOUBLE) END AS q FROM totalled)
    SELECT entity_id, count(*) AS categories, round(sum((p - q) * ln(p / q)), 9) AS psi
    FROM shares GROUP BY entity_id""",
)
def _(spark, sf_dir):
    found = drift.categorical_psi(_category_counts(spark, sf_dir), "entity_id")
    return found.select("entity_id", "categories", F.round("psi", 9).alias("psi"))


@query(
    "chi_square",
    f"""{_CATEGORIES},
    expected AS (
      SELECT *, CAST(hist + curr AS DOUBLE) * n_hist / (n_hist + n_curr) AS eh,
                CAST(hist + curr AS DOUBLE) * n_curr / (n_hist + n_curr) AS ec FROM totalled)
    SELECT entity_id, round(sum((hist - eh) * (hist - eh) / eh + (curr - ec) * (curr - ec) / ec), 9) AS chi_square,
           count(*) - 1 AS degrees FROM expected GROUP BY entity_id""",
)
def _(spark, sf_dir):
    found = drift.chi_square(_category_counts(spark, sf_dir), "entity_id")
    return found.select("entity_id", F.round("chi_square", 9).alias("chi_square"), "degrees")


@query(
    "label_drift",
    f"""WITH {base.LABEL_SQL},
    counts AS (SELECT strftime(date_trunc('week', labeled_at), '%Y-%m-%d') AS period, label, count(*) AS n
               FROM late_labels GROUP BY ALL)
    SELECT period, label, n, round(n / CAST(sum(n) OVER (PARTITION BY period) AS DOUBLE), 9) AS share
    FROM counts""",
)
def _(spark, sf_dir):
    week = F.date_format(F.date_trunc("week", "labeled_at"), "yyyy-MM-dd")
    shares = serving.label_shares(base.late_labels(spark, sf_dir), week)
    return shares.select("period", "label", "n", F.round("share", 9).alias("share"))


@query(
    "label_psi",
    f"""WITH {base.LABEL_SQL},
    counts AS (SELECT date_trunc('week', labeled_at) AS w, label, count(*) AS n FROM late_labels WHERE label IS NOT NULL GROUP BY ALL),
    totals AS (SELECT w, sum(n) AS total, lag(w) OVER (ORDER BY w) AS b FROM counts GROUP BY w),
    pairs AS (
      SELECT t.w, t.b, l.label, t.total, p.total AS total_before, coalesce(c.n, 0) AS curr, coalesce(h.n, 0) AS hist
      FROM totals t JOIN totals p ON p.w = t.b CROSS JOIN (SELECT DISTINCT label FROM counts) l
      LEFT JOIN counts c ON c.w = t.w AND c.label = l.label LEFT JOIN counts h ON h.w = t.b AND h.label = l.label
      WHERE coalesce(c.n, 0) + coalesce(h.n, 0) > 0),
    shares AS (
      SELECT *, CASE WHEN curr = 0 THEN 1e-10 ELSE curr / CAST(total AS DOUBLE) END AS p,
                CASE WHEN hist = 0 THEN 1e-10 ELSE hist / CAST(total_before AS DOUBLE) END AS q FROM pairs)
    SELECT strftime(w, '%Y-%m-%d') AS period, strftime(b, '%Y-%m-%d') AS before, total::BIGINT AS n, total_before::BIGINT AS n_before,
           round(sum((p - q) * ln(p / q)), 9) AS psi FROM shares GROUP BY ALL""",
)
def _(spark, sf_dir):
    week = F.date_format(F.date_trunc("week", "labeled_at"), "yyyy-MM-dd")
    return serving.label_psi(base.late_labels(spark, sf_dir), week).withColumn("psi", F.round("psi", 9))


# --- baselines ---------------------------------------------------------------------------

_HITS = " + ".join(
    f"CASE WHEN value >= low + {i} * ((high - low) / 10) THEN 1 ELSE 0 END" for i in range(1, 10)
)
_BASELINE = f"""WITH {log_sql()},
    ranges AS (SELECT feature_name, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std,
                      min(value) AS low, max(value) AS high
               FROM log WHERE event_timestamp < TIMESTAMP '2024-01-15' GROUP BY feature_name),
    placed AS (SELECT l.feature_name, event_timestamp >= TIMESTAMP '2024-01-15' AS live, {_HITS} AS bin
               FROM log l JOIN ranges r USING (feature_name)),
    bins AS (SELECT r.*, b.bin, count(*) FILTER (WHERE p.live = false) AS hist,
                    count(*) FILTER (WHERE p.live) AS curr
             FROM ranges r CROSS JOIN range(10) b(bin)
             LEFT JOIN placed p ON p.feature_name = r.feature_name AND p.bin = b.bin GROUP BY ALL)"""


def _trained_and_live(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    trained = F.col("event_timestamp") < F.lit("2024-01-15").cast("timestamp")
    return log.filter(trained), log.filter(~trained)


@query(
    "baseline_stats",
    f"""{_BASELINE} SELECT feature_name, n, round(mean, 6) AS mean, round(std, 6) AS std, low, high,
        string_agg(CAST(hist AS VARCHAR), ',' ORDER BY bin) AS bins FROM bins GROUP BY ALL""",
)
def _(spark, sf_dir):
    saved = drift.baseline_statistics(_trained_and_live(spark, sf_dir)[0])
    return saved.select(
        "feature_name",
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
        "low",
        "high",
        F.array_join(F.col("bins").cast("array<string>"), ",").alias("bins"),
    )


@query(
    "baseline_drift",
    f"""{_BASELINE},
    shares AS (SELECT *, CASE WHEN curr = 0 THEN 1e-10 ELSE curr / CAST(sum(curr) OVER (PARTITION BY feature_name) AS DOUBLE) END AS p,
               CASE WHEN hist = 0 THEN 1e-10 ELSE hist / CAST(n AS DOUBLE) END AS q FROM bins),
    normed AS (SELECT *, p / sum(p) OVER (PARTITION BY feature_name) AS pn,
               q / sum(q) OVER (PARTITION BY feature_name) AS qn FROM shares)
    SELECT feature_name, round(sum((p - q) * ln(p / q)), 9) AS psi,
           round(sum(pn * ln(pn / qn)), 9) AS kl_divergence FROM normed GROUP BY feature_name""",
)
def _(spark, sf_dir):
    trained, live = _trained_and_live(spark, sf_dir)
    found = drift.baseline_drift(drift.baseline_statistics(trained), live)
    return found.select(
        "feature_name",
        F.round("psi", 9).alias("psi"),
        F.round("kl_divergence", 9).alias("kl_divergence"),
    )


# --- samples, percentiles, sketches ------------------------------------------------------


@query(
    "seeded_sample",
    f"""WITH {log_sql()}
    SELECT event_id, feature_name, value FROM (
      SELECT *, row_number() OVER (PARTITION BY feature_name ORDER BY md5(CAST(event_id AS VARCHAR))) AS rn
      FROM log) WHERE rn <= 1000""",
)
def _(spark, sf_dir):
    # The sample size is the operator: about a thousand values per feature.
    drawn = selection.seeded_sample(
        feature_log(spark, sf_dir), "feature_name", F.col("event_id").cast("string"), 1000
    )
    return drawn.select("event_id", "feature_name", "value")


@query(
    "latency_p95",
    """SELECT l_linestatus AS route, count(*) AS n,
        round(quantile_cont(date_diff('day', o_orderdate, l_shipdate) + l_quantity / CAST(100 AS DOUBLE), 0.95), 6) AS p95
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_linestatus""",
)
def _(spark, sf_dir):
    items, orders = base.table(spark, sf_dir, "lineitem"), base.table(spark, sf_dir, "orders")
    waits = items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("l_linestatus").alias("route"),
        (F.date_diff("l_shipdate", "o_orderdate") + F.col("l_quantity") / 100.0).alias("wait"),
    )
    found = selection.exact_percentile(stored(waits, "waits"), "route", "wait", 0.95)
    return found.select("route", "n", F.round("percentile", 6).alias("p95"))


@query(
    "interval_analysis",
    f"""WITH {log_sql()},
    recent AS (SELECT value FROM log WHERE event_timestamp >
               (SELECT max(event_timestamp) FROM log) - INTERVAL 36 HOURS)
    SELECT 'success' AS status, count(value) AS analyzed_centroids, count(value) AS total_weight,
           round(coalesce(avg(value), 0), 6) AS calculated_mean, false AS drift_detected,
           'Analysis complete' AS message FROM recent""",
)
def _(spark, sf_dir):
    answer = sketch.analyze_interval(
        feature_log(spark, sf_dir), "value", F.expr("INTERVAL 36 HOURS")
    )
    return answer.drop("result_json").withColumn(
        "calculated_mean", F.round("calculated_mean", 6)
    )


@query(
    "named_analysis",
    f"""WITH {log_sql()}
    SELECT count(value) AS total_weight, round(avg(value), 6) AS calculated_mean FROM log
    WHERE event_timestamp > (SELECT max(event_timestamp) FROM log) - INTERVAL 36 HOURS""",
)
def _(spark, sf_dir):
    name = f"log_{uuid.uuid4().hex}"
    feature_log(spark, sf_dir).createOrReplaceTempView(name)
    answer = sketch.analyze_table(spark, "36 HOURS", name, "value")
    return answer.select("total_weight", F.round("calculated_mean", 6).alias("calculated_mean"))


@query(
    "trailing_scan",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAYS""",
)
def _(spark, sf_dir):
    newest = base.table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    options = {"path": f"{sf_dir}/orders.parquet"}
    return tables.trailing_scan(
        spark, "parquet", options, F.expr("INTERVAL 90 DAYS"), newest, ["o_orderkey", "o_totalprice"], time="o_orderdate"
    )


@query(
    "quantile_sketch",
    "SELECT event_type AS feature_name, count(*) AS n, true AS within_bound FROM events GROUP BY 1",
)
def _(spark, sf_dir):
    # Daily sketches merged; the median read from them must have an exact rank near one half.
    log = feature_log(spark, sf_dir).withColumn("day", F.to_date("event_timestamp"))
    daily = sketch.sketch_by(log, ["feature_name", "day"])
    medians = sketch.read_quantiles(
        sketch.merge_sketches(daily, ["feature_name"]), ["feature_name"], [0.5]
    )
    checked = log.join(medians, "feature_name").groupBy("feature_name", "n")
    rank = F.avg((F.col("value") <= F.col("q50")).cast("double"))
    return checked.agg((F.abs(rank - 0.5) < 0.03).alias("within_bound"))


@query(
    "sketch_drift",
    f"{METRICS} SELECT g AS feature_name, n_hist, n_curr, true AS near_exact FROM metrics",
)
def _(spark, sf_dir):
    slices = stored(slices_of(spark, sf_dir), "slices")
    approximate = sketch.sketch_distance(slices)
    exact = distribution.ks_distance(distribution.bin_values(numeric_values(slices)))
    return approximate.join(exact.select("feature_name", "ks_stat"), "feature_name").select(
        "feature_name",
        "n_hist",
        "n_curr",
        (F.abs(F.col("sketch_ks") - F.col("ks_stat")) < 0.03).alias("near_exact"),
    )
