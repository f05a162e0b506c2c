"""Exact search for the largest inner products by elimination with a pivot table.

Vectors are scaled to whole numbers, so scores are exact. The distance of every vector to each of
many pivots is computed once and kept in a table. For a query, |d(q, p) - d(x, p)| over all pivots
gives the greatest lower bound on the distance, and with the norms an upper bound on the inner product:
2 q.x = |q|^2 + |x|^2 - d(q, x)^2. Candidates are taken in the order of that bound until the
bound falls below the k-th score found.

Queries and candidates meet in blocks of bounded size: a task holds one block of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import stored

PIVOTS = 16
# Pivots are chosen among at most this many vectors.
PIVOT_SAMPLE = 1_024
QUERY_BLOCK = 1_024
CANDIDATE_BLOCK = 8_192
# Room for rounding in a bound on whole numbers.
SLACK = 1e-6


def usable(vector: str) -> Column:
    """Vectors that are not null or empty and hold only finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def far_apart(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Farthest-first choice: every pivot is the sample vector farthest from those chosen before."""
    if not len(sample):
        return sample
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def pivot_table(vectors: DataFrame, pivots: np.ndarray, scale: int) -> DataFrame:
    """Rows (vec_id, whole, norm, gaps): the scaled vector, its squared norm and its distance to every pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            sizes = np.diff(offsets)
            whole = np.floor(scale * flat.astype(np.float64))
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            norm = np.add.reduceat(whole**2, starts) if len(whole) else np.zeros(0)
            gaps = np.zeros((batch.num_rows, len(pivots)))
            fits = sizes == (pivots.shape[1] if len(pivots) else -1)
            if fits.any():
                rows = np.stack([whole[s : s + pivots.shape[1]] for s in starts[fits]])
                squared = norm[fits][:, None] + (pivots**2).sum(1)[None, :] - 2 * rows @ pivots.T
                gaps[fits] = np.sqrt(np.maximum(squared, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(np.append(starts, len(whole)).astype(np.int32)), pa.array(whole)),
                    pa.array(norm),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, gaps.size + 1, max(1, gaps.shape[1]), dtype=np.int32)[: batch.num_rows + 1])
                        if gaps.shape[1]
                        else pa.array(np.zeros(batch.num_rows + 1, np.int32)),
                        pa.array(gaps.ravel()),
                    ),
                ],
                ["vec_id", "whole", "norm", "gaps"],
            )

    return vectors.mapInArrow(run, "vec_id long, whole array<double>, norm double, gaps array<double>")


def best_of_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of one block for every query of one block."""
    ids = candidates["vec_id"].to_numpy()
    rows = np.stack(candidates["whole"].to_numpy())
    norms = candidates["norm"].to_numpy()
    gaps = np.stack(candidates["gaps"].to_numpy())
    found: list[tuple[int, int, int]] = []
    for query_id, query, norm, gap in queries[["query_id", "query", "query_norm", "query_gaps"]].itertuples(index=False):
        apart = np.abs(gaps - gap).max(1) if gaps.shape[1] else np.zeros(len(ids))
        bound = (norm + norms - apart**2) / 2
        bound += SLACK * (1 + np.abs(bound))
        bound[ids == query_id] = -np.inf
        order = np.argsort(-bound)
        best_ids, best_scores, at, step = np.empty(0, np.int64), np.empty(0), 0, 256
        while at < len(order) and bound[order[at]] > -np.inf:
            if len(best_ids) == k and bound[order[at]] < best_scores[-1]:
                break
            chosen = order[at : at + step]
            if len(best_ids) == k:
                chosen = chosen[bound[chosen] >= best_scores[-1]]
            chosen = chosen[bound[chosen] > -np.inf]
            scores = rows[chosen] @ query
            best_ids, best_scores = np.append(best_ids, ids[chosen]), np.append(best_scores, scores)
            keep = np.lexsort((best_ids, -best_scores))[:k]
            best_ids, best_scores = best_ids[keep], best_scores[keep]
            at, step = at + step, step * 4
        found += [(query_id, int(i), int(s)) for i, s in zip(best_ids, best_scores)]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def largest_products(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k largest integer inner products of each query.

    Components become floor(scale * x). Every row but the query's own is a candidate; ties go to the
    smaller id. Vectors that are null, empty or hold null or non-finite components take no part, nor
    do rows with a null id; vectors of different lengths are never compared. A repeated row counts as
    one. Fewer candidates than k give as many ranks; an empty table gives no rows. Whole numbers must
    stay below 2**53 in a score. Other columns are not read.
    """
    clean = (
        vectors.where(F.col(id_col).isNotNull() & usable(vector_col))
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asked"),
        )
        .dropDuplicates(["vec_id", "vector"])
    )
    flags = clean.select("vec_id", "asked").where("asked").distinct()
    spark = vectors.sparkSession
    sample = clean.orderBy(F.xxhash64(F.lit(11), "vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("vector").collect()
    usual = max((len(row["vector"]) for row in sample), default=0)
    known = [row["vector"] for row in sample if len(row["vector"]) == usual]
    chosen = far_apart(np.floor(scale * np.array(known, dtype=np.float64).reshape(len(known), usual)), pivots)
    table = stored(pivot_table(clean.select("vec_id", "vector"), chosen, scale), "pivots")
    counted = table.count()
    queries = table.join(flags, "vec_id", "left_semi")
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    candidate_blocks = max(1, -(-counted // CANDIDATE_BLOCK))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    asked = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("whole").alias("query"),
        F.col("norm").alias("query_norm"),
        F.col("gaps").alias("query_gaps"),
        F.size("whole").alias("length"),
        block(query_blocks).alias("q"),
    ).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))))
    offered = (
        table.select(
            *[F.col(name).alias(name) for name in table.columns],
            F.size("whole").alias("length"),
            block(candidate_blocks).alias("c"),
        ).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return best_of_block(left, right, k)

    partial = (
        asked.groupBy("length", "q", "c")
        .cogroup(offered.groupBy("length", "q", "c"))
        .applyInPandas(meet, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
