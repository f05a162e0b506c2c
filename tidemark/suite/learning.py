"""Queries on training, evaluation, promotion and batch inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import learning, publication
from tidemark.runtime import scratch_path
from tidemark.suite.base import query, table

PRICE = learning.ModelSpec("Price", "linear", ("quantity", "tax"), "price")
RETURNED = learning.ModelSpec("Returned", "logistic", ("quantity", "discount"), "returned", classes=2)
QUARTER = learning.ModelSpec("Quarter", "tree", ("price", "month"), "quarter", classes=4)

# Least squares with two inputs in closed form, from covariances.
_LINEAR = """fitted AS (
      SELECT ax, bx, ay - ax * mx1 - bx * mx2 AS intercept FROM (
        SELECT (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS ax,
               (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS bx, mx1, mx2, my AS ay
        FROM (SELECT var_pop(l_quantity) AS c11, var_pop(l_tax) AS c22, covar_pop(l_quantity, l_tax) AS c12,
                     covar_pop(l_quantity, l_extendedprice) AS c1y, covar_pop(l_tax, l_extendedprice) AS c2y,
                     avg(l_quantity) AS mx1, avg(l_tax) AS mx2, avg(l_extendedprice) AS my FROM lineitem)))"""


def items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_tax").alias("tax"),
        F.col("l_discount").alias("discount"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_returnflag") == "R").cast("double").alias("returned"),
    )


@query(
    "train_linear",
    f"""WITH {_LINEAR} SELECT 'quantity' AS term, round(ax, 3) AS coefficient FROM fitted
    UNION ALL SELECT 'tax', round(bx, 3) FROM fitted UNION ALL SELECT 'intercept', round(intercept, 3) FROM fitted""",
)
def _(spark, sf_dir):
    model = learning.fit(PRICE, items(spark, sf_dir)).stages[-1]
    terms = [*zip(PRICE.features, model.coefficients.tolist()), ("intercept", model.intercept)]
    rows = spark.createDataFrame(terms, "term string, coefficient double")
    return rows.select("term", F.round("coefficient", 3).alias("coefficient"))


_BUCKET = "CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % 100"
_SPLIT = f"""items AS (
      SELECT l_tax AS tax, l_quantity AS quantity, l_extendedprice AS price,
             {_BUCKET.format(key="l_orderkey || '-' || l_linenumber")} < 80 AS train FROM lineitem)"""


@query(
    "train_logistic",
    f"""WITH {_SPLIT} SELECT 'Returned' AS model_id, count(*) FILTER (WHERE train) AS trained,
      count(*) FILTER (WHERE NOT train) AS tested, true AS at_optimum FROM items""",
)
def _(spark, sf_dir):
    rows = items(spark, sf_dir)
    model, score = learning.train_job(RETURNED, rows, F.col("key"))
    # The penalised loss is convex: its fit is right where the gradient is zero.
    fitted = model.stages[-1]
    weights, names = fitted.coefficients.tolist(), RETURNED.features
    margin = sum((F.col(n) * w for n, w in zip(names, weights)), F.lit(fitted.intercept))
    miss = 1 / (1 + F.exp(-margin)) - F.col("returned")
    train, _ = learning.hash_split(rows, F.col("key"))
    slopes = [F.avg(miss * F.col(n)) + w / F.count(F.lit(1)) for n, w in zip(names, weights)]
    steepest = F.greatest(*[F.abs(slope) for slope in [*slopes, F.avg(miss)]])
    checked = train.agg(F.count(F.lit(1)).alias("trained"), (steepest < 1e-3).alias("at_optimum"))
    return score.crossJoin(checked).select("model_id", "trained", "tested", "at_optimum")


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_totalprice").alias("price"),
        F.month("o_orderdate").alias("month"),
        (F.quarter("o_orderdate") - 1).cast("double").alias("quarter"),
    )


# Three cuts of the month separate the quarters, so the tree must find them all.
@query(
    "train_tree",
    f"""SELECT 'Quarter' AS model_id, count(*) AS tested, CAST(1 AS DOUBLE) AS score FROM orders
    WHERE {_BUCKET.format(key="CAST(o_orderkey AS VARCHAR)")} >= 80""",
)
def _(spark, sf_dir):
    _, score = learning.train_job(QUARTER, _orders(spark, sf_dir), F.col("key"))
    return score


# Both fits in closed form on the training rows, judged by R2 on the others.
_SCORES = f"""WITH {_SPLIT}, moments AS (
      SELECT var_pop(quantity) AS c11, var_pop(tax) AS c22, covar_pop(quantity, tax) AS c12, covar_pop(quantity, price) AS c1y,
             covar_pop(tax, price) AS c2y, avg(quantity) AS m1, avg(tax) AS m2, avg(price) AS my FROM items WHERE train),
    slopes AS (
      SELECT *, c2y / c22 AS alone, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS s1,
             (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS s2 FROM moments),
    judged AS (
      SELECT price, my + alone * (tax - m2) AS old_said, my + s1 * (quantity - m1) + s2 * (tax - m2) AS new_said
      FROM items CROSS JOIN slopes WHERE NOT train),
    scores AS (
      SELECT 1 - sum((price - old_said) ** 2) / (var_pop(price) * count(*)) AS old_score,
             1 - sum((price - new_said) ** 2) / (var_pop(price) * count(*)) AS new_score FROM judged)"""


@query(
    "champion",
    f"""{_SCORES}
    SELECT 'Price' AS model_id, round(old_score, 6) AS old_score, round(new_score, 6) AS new_score,
           new_score > old_score AS promoted FROM scores""",
)
def _(spark, sf_dir):
    # Challenger with one more input than the champion, judged on the same held-out rows.
    old = learning.ModelSpec("Price", "linear", ("tax",), "price")
    rows = items(spark, sf_dir)
    _, old_score = learning.train_job(old, rows, F.col("key"))
    _, new_score = learning.train_job(PRICE, rows, F.col("key"))
    decided = learning.promote(old_score, new_score)
    return decided.select(
        "model_id",
        F.round("old_score", 6).alias("old_score"),
        F.round("new_score", 6).alias("new_score"),
        "promoted",
    )


# The weaker model is in production first, the stronger one takes over, the weaker one trained again does not.
@query(
    "model_publication",
    f"""{_SCORES}
    SELECT 'first' AS job_id, '0.1.0' AS version, 'archived' AS status, round(old_score, 6) AS score, NULL::DOUBLE AS mean_said FROM scores
    UNION ALL SELECT 'third', '0.1.2', 'archived', round(old_score, 6), NULL FROM scores
    UNION ALL SELECT 'second', '0.1.1', 'production', round(new_score, 6), (SELECT round(avg(new_said), 4) FROM judged) FROM scores""",
)
def _(spark, sf_dir):
    store, root = publication.model_store(spark, scratch_path(spark, "registry")), scratch_path(spark, "models")
    old = learning.ModelSpec("Price", "linear", ("tax",), "price")
    rows = items(spark, sf_dir)
    for job, spec in (("first", old), ("second", PRICE), ("third", old)):
        model, score = learning.train_job(spec, rows, F.col("key"))
        for _attempt in range(2):
            publication.publish(model, spec, score.first()["score"], job, store, root)
            publication.promote_job(job, store)
    row, model = publication.in_production(store, "Price")
    _, test = learning.hash_split(rows, F.col("key"))
    said = model.transform(test).agg(F.round(F.avg("prediction"), 4)).first()[0]
    return store.read().select(
        "job_id", "version", "status", F.round("score", 6).alias("score"), F.when(F.col("job_id") == row["job_id"], F.lit(said)).alias("mean_said")
    )


@query(
    "batch_inference",
    f"""WITH {_LINEAR}, requests AS (
      SELECT l_orderkey || '-' || l_linenumber AS request_id, l_quantity, l_tax,
             CASE WHEN l_orderkey % 10 = 0 THEN 'Nothing' ELSE 'Price' END AS model_id,
             l_orderkey % 7 = 0 AS bad FROM lineitem)
    SELECT request_id, model_id,
      CASE WHEN model_id = 'Nothing' OR bad THEN CAST(-1 AS DOUBLE)
           ELSE round(intercept + ax * l_quantity + bx * l_tax, 2) END AS prediction,
      CASE WHEN model_id = 'Nothing' THEN 'Model Nothing not found'
           WHEN bad THEN 'Prediction failed: input missing or no number' ELSE '' END AS error
    FROM requests CROSS JOIN fitted""",
)
def _(spark, sf_dir):
    model = learning.fit(PRICE, items(spark, sf_dir))
    key = F.col("l_orderkey")
    requests = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", key.cast("string"), F.col("l_linenumber").cast("string")).alias("request_id"),
        F.when(key % 10 == 0, "Nothing").otherwise("Price").alias("model_id"),
        F.create_map(
            F.lit("quantity"),
            F.when(key % 7 == 0, "many").otherwise(F.col("l_quantity").cast("string")),
            F.lit("tax"),
            F.col("l_tax").cast("string"),
        ).alias("features"),
    )
    scored = learning.batch_inference(requests, {"Price": (PRICE, model)})
    return scored.withColumn("prediction", F.round("prediction", 2))
