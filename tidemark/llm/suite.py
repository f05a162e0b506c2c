"""Registered queries of the corpus operators, each with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    clusters,
    fingerprints,
    language_model,
    licenses,
    lines,
    mixing,
    neardup,
    packing,
    pivots,
    quality,
    resampling,
    secret_scan,
    separators,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- op3 -----------------------------------------------------------------------------------


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def total(kind: str):
        return F.size(F.filter("findings", lambda f: f["rule"] == kind)).cast("long").alias(f"n_{kind}")

    spans = F.array_join(
        F.transform("findings", lambda f: F.concat_ws(":", f["rule"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id", total("assign"), total("access"), total("hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )


# --- op7 -----------------------------------------------------------------------------------


@query("op7_packing")
def op7_packing(spark, sf_dir):
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


# --- op9 -----------------------------------------------------------------------------------


@query("op9_near_duplicates")
def op9_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


# --- op10 ----------------------------------------------------------------------------------

TOP_SQL = """
WITH clean AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.whole, c.whole) AS BIGINT) AS score
    FROM clean q JOIN clean c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op10_exact_topk", TOP_SQL)
def op10_exact_topk(spark, sf_dir):
    return pivots.largest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# --- op4 -----------------------------------------------------------------------------------


@query("op4_fingerprints")
def op4_fingerprints(spark, sf_dir):
    def text(column: str):
        return F.lpad(F.lower(F.hex(column)), 16, "0")

    prints = fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))
    return prints.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text("fp").alias("fingerprint"),
        text("edited_fp").alias("edited_fingerprint"),
        fingerprints.likeness("fp", "edited_fp").alias("near_edited"),
        fingerprints.likeness("fp", "next_fp").alias("near_next"),
        F.col("near").alias("n_near"),
    )


# --- op1 -----------------------------------------------------------------------------------


@query("op1_quality")
def op1_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.scored(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"),
    )


# --- op5 -----------------------------------------------------------------------------------


@query("op5_line_dedup")
def op5_line_dedup(spark, sf_dir):
    found = lines.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line_no", "class_doc_id", "class_line_no", "kept")


# --- op2 -----------------------------------------------------------------------------------


@query("op2_license_scan")
def op2_license_scan(spark, sf_dir):
    return licenses.license_hits(table(spark, sf_dir, "documents"))


# --- op6 -----------------------------------------------------------------------------------


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    return separators.document_token_counts(table(spark, sf_dir, "documents"))


# --- op8 -----------------------------------------------------------------------------------


@query("op8_mixing")
def op8_mixing(spark, sf_dir):
    found = mixing.mixed(table(spark, sf_dir, "documents"), mixing.corpus_margins(), mixing.SHARE)
    return found.select(
        "doc_id",
        F.col("mix_source").alias("source"),
        F.col("mix_lang").alias("lang"),
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_probability").alias("probability"),
        F.col("mix_kept").alias("kept"),
    )


# --- op11 ----------------------------------------------------------------------------------


def lloyd_sql() -> str:
    """The rounds one after the other, over long rows (vector, component)."""

    def nearest(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
    SELECT n, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
        SELECT v.n, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM part v JOIN c{n} c USING (i) GROUP BY ALL
    ) GROUP BY n
)"""

    def moved(n: int) -> str:
        return f"""
c{n + 1} AS MATERIALIZED (
    SELECT c.cluster, c.i, coalesce(((s.total - ((s.total % s.rows) + s.rows) % s.rows) // s.rows)::BIGINT, c.x) AS x
    FROM c{n} c LEFT JOIN (
        SELECT a.cluster, v.i, sum(v.x)::BIGINT AS total, count(*) AS rows FROM part v JOIN a{n} a USING (n) GROUP BY ALL
    ) s USING (cluster, i)
)"""

    rounds = [step for n in range(clusters.ROUNDS) for step in (nearest(n), moved(n))] + [nearest(clusters.ROUNDS)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
    FROM embeddings
    WHERE len(embedding) = {clusters.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
    SELECT n, unnest(range({clusters.DIMENSIONS})) AS i, unnest(whole) AS x FROM kept
), first AS MATERIALIZED (
    SELECT n, row_number() OVER (ORDER BY sha256('{clusters.SEED}:' || coalesce(vec_id::VARCHAR, '')), whole) - 1 AS cluster FROM kept
), c0 AS MATERIALIZED (
    SELECT f.cluster, p.i, p.x FROM first f JOIN part p USING (n) WHERE f.cluster < {clusters.CLUSTERS}
),{",".join(rounds)}, named AS (
    SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{clusters.ROUNDS} GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
    (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{clusters.ROUNDS} JOIN kept USING (n) JOIN named USING (cluster)
"""


@query("op11_centroid_clusters", lloyd_sql())
def op11_centroid_clusters(spark, sf_dir):
    found, centroids = clusters.lloyd(table(spark, sf_dir, "embeddings"))
    return clusters.with_inertia(found, centroids).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


# --- op12 ----------------------------------------------------------------------------------

# crc32 bit by bit over the bytes of each distinct word.
RESAMPLED_SQL = f"""
WITH words AS MATERIALIZED (
    SELECT n, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM (
        SELECT row_number() OVER () AS n, doc_id, text FROM documents
        UNION ALL SELECT NULL, NULL, text FROM benchmark
    )
), bytes AS (
    SELECT word, list_transform(range(1, len(hex(word)) + 1, 2), lambda i: CAST('0x' || substr(hex(word), i, 2) AS BIGINT)) AS b
    FROM (SELECT DISTINCT word FROM words)
), hashed AS MATERIALIZED (
    SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: list_reduce(
        [xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, i: xor(a >> 1, 3988292384 * (a & 1))))) % {resampling.BUCKETS} AS bucket
    FROM bytes
), counted AS (
    SELECT bucket, count(n) AS s, count(*) - count(n) AS t FROM words JOIN hashed USING (word) GROUP BY bucket
), gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + {resampling.BUCKETS}))
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + {resampling.BUCKETS}))))::BIGINT AS gain
    FROM counted
), weights AS (
    SELECT n, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket)
    WHERE n IS NOT NULL GROUP BY n
), scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('{resampling.SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
    )))::BIGINT AS score
    FROM (SELECT row_number() OVER () AS n, doc_id FROM documents) d LEFT JOIN weights USING (n)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
        count(*) OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS}) AS able
    FROM scored
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_features >= {resampling.LEAST_WORDS} AND place <= {resampling.DRAWN_PERCENT} * able // 100 THEN place END AS rank
FROM placed
"""


@query("op12_importance_resampling", RESAMPLED_SQL)
def op12_importance_resampling(spark, sf_dir):
    found = resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# --- op13 ----------------------------------------------------------------------------------


@query("op13_lm_scores")
def op13_lm_scores(spark, sf_dir):
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    found = language_model.scored(table(spark, sf_dir, "documents"), F.crc32(name) % 10 == 0)
    return found.withColumnRenamed("id", "doc_id")
