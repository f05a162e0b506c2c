"""Centroid clustering: Lloyd's rounds with the dimensions dealt to shards.

Vectors are written once as blocks: a chunk of rows by a shard of columns. In a round every column
block computes its exact partial distances against its own slice of the centroids; the partial
distances of a chunk are added by key, and the sum decides the nearest centroid. The slices of the
chunk travel along, so that the new sums of each shard come out of the same task; sums and counts are
added by (shard's dimension, cluster) on Spark, and every slice is replaced from its own sums.

A group holds one chunk, whatever the clusters look like: a cluster or an id with a third of all rows
is spread over as many tasks as it has chunks. The driver holds centroids only, k x dimensions numbers.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import stored

SCALE = 256
SEED = 2
CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
# Columns in a shard, rows in a chunk: a group of partial distances is a chunk by the number of clusters.
SHARD = 16
CHUNK = 8192
# Sums leave a task as digits of this base, so that numbers of any size are added exactly.
BASE = 10**18
LARGEST = (1 << 63) - 1

BLOCKS = "chunk long, shard int, ids array<long>, data binary"


def usable(array: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a list column, and their whole components floor(SCALE * x) as doubles.

    Usable: exactly ``dimensions`` components, none null or non-finite, also not once scaled.
    """
    array = array.cast(pa.large_list(pa.float64()))
    sizes = array.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(sizes == dimensions)
    values = array.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(SCALE * values.reshape(-1, dimensions))
    kept = np.isfinite(whole).all(1)
    return places[kept], whole[kept]


def compact(whole: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them; doubles hold what no integer type does."""
    peak = float(np.abs(whole).max(initial=0))
    for kind in (np.int16, np.int32):
        if peak <= np.iinfo(kind).max:
            return whole.astype(kind)
    return whole


def exact(whole: np.ndarray, bound: float) -> np.ndarray:
    """Numbers to calculate with: doubles while no result passes 2**53, Python integers beyond."""
    if bound < 1 << 53:
        return whole.astype(np.float64)
    return np.array([[int(x) for x in row] for row in whole], dtype=object).reshape(whole.shape)


def partial_distances(rows: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids over the columns of one shard, exact."""
    peak = max([abs(float(x)) for x in (rows.max(initial=0), rows.min(initial=0), *slice_.ravel())])
    bound = 4.0 * peak * peak * rows.shape[1]
    a, c = exact(rows, bound), exact(slice_, bound)
    found = (a * a).sum(1)[:, None] - 2 * a.dot(c.T) + (c * c).sum(1)
    if found.dtype == object:
        return found
    kind = np.uint32 if found.max(initial=0) < 1 << 32 else np.int64
    return found.astype(kind)


def added(parts: list[np.ndarray]) -> np.ndarray:
    """Sum of partial distances, in Python integers if one of them needs these."""
    wide = any(part.dtype == object for part in parts)
    total = parts[0].astype(object if wide else np.float64)
    for part in parts[1:]:
        total = total + part
    if not wide and total.max(initial=0) >= 1 << 53:
        return added([part.astype(object) for part in parts])
    return total


def column_blocks(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, shard: int, chunk: int) -> DataFrame:
    """Rows (chunk, shard, ids, data): the whole components of the usable vectors; ids stand in shard 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held_ids: list[int | None] = []
        held = np.zeros((0, dimensions))
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                places, whole = usable(batch.column(1), dimensions)
                held_ids += batch.column(0).take(pa.array(places)).to_pylist()
                held = np.vstack([held, whole])
            while len(held) >= chunk or (batch is None and len(held)):
                part, ids = held[:chunk], held_ids[:chunk]
                held, held_ids = held[chunk:], held_ids[chunk:]
                starts = range(0, dimensions, shard)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(starts), pa.int64()),
                        pa.array(range(len(starts)), pa.int32()),
                        pa.array([ids if s == 0 else None for s in starts], pa.list_(pa.int64())),
                        pa.array([pickle.dumps(compact(part[:, s : s + shard])) for s in starts], pa.binary()),
                    ],
                    ["chunk", "shard", "ids", "data"],
                )
                number += 1

    return vectors.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(run, BLOCKS)


def starting_centroids(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, clusters: int, seed: int) -> np.ndarray:
    """The kept vectors with the smallest sha256 of ``seed:id``, in that order; a null id hashes as empty.

    Rows with the same id follow the order of their components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of every batch only those can be among the first that are among the first of the batch.
        for batch in batches:
            places, whole = usable(batch.column(1), dimensions)
            ids = batch.column(0).take(pa.array(places)).to_pylist()
            names = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i in ids]
            first = sorted((name, row.tolist()) for name, row in zip(names, whole))[:clusters]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in first], pa.string()), pa.array([r for _, r in first], pa.list_(pa.float64()))],
                ["name", "whole"],
            )

    rows = vectors.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(run, "name string, whole array<double>")
    first = rows.orderBy("name", "whole").limit(clusters).collect()
    return np.array([[int(x) for x in row["whole"]] for row in first], dtype=object).reshape(len(first), dimensions)


def with_partials(blocks: DataFrame, centroids: np.ndarray, shard: int) -> DataFrame:
    """Column blocks with their partial distances against their shard's slice of the centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                begin = row.column(1)[0].as_py() * shard
                found = partial_distances(pickle.loads(row.column(3)[0].as_py()), centroids[:, begin : begin + shard])
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, pa.array([pickle.dumps(found)], pa.binary())], ["chunk", "shard", "ids", "data", "part"]
                )

    return blocks.mapInArrow(run, BLOCKS + ", part binary")


def nearest(parts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, the smaller number at a tie, and its distance."""
    total = added([pickle.loads(part) for part in parts])
    labels = np.argmin(total, axis=1) if total.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in total])
    return labels, total[np.arange(len(total)), labels]


def digits(number: int) -> list[int]:
    """Digits of a whole number to the base BASE, lowest first, all of its sign."""
    sign, rest, found = (-1 if number < 0 else 1), abs(number), []
    while rest:
        rest, digit = divmod(rest, BASE)
        found.append(sign * digit)
    return found


def chunk_sums(shard: int, clusters: int):
    """Sums per cluster and dimension and counts (dimension -1) of one chunk, after its partial distances were added."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        labels, _ = nearest(rows["part"])
        found = [(cluster, -1, 0, int(n)) for cluster, n in enumerate(np.bincount(labels, minlength=clusters)) if n]
        present = [cluster for cluster, *_ in found]
        for place, data in zip(rows["shard"], rows["data"]):
            part = pickle.loads(data)
            whole = exact(part, float(np.abs(part.astype(np.float64)).max(initial=0)) * len(part))
            for cluster in present:
                for at, total in enumerate(whole[labels == cluster].sum(0)):
                    found += [(cluster, place * shard + at, level, d) for level, d in enumerate(digits(int(total)))]
        return pd.DataFrame(found, columns=["cluster", "dimension", "level", "total"])

    return run


def updated(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Every slice replaced by floor(sum / count) of its own dimensions; empty clusters stay."""
    added_up = sums.groupBy("cluster", "dimension", "level").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    counts, totals = {}, {}
    for row in added_up.collect():
        place = (row["cluster"], row["dimension"])
        if row["dimension"] < 0:
            counts[row["cluster"]] = int(row["total"])
        else:
            totals[place] = totals.get(place, 0) + int(row["total"]) * BASE ** row["level"]
    new = centroids.copy()
    for cluster, count in counts.items():
        new[cluster] = [totals.get((cluster, at), 0) // count for at in range(centroids.shape[1])]
    return new


def assigned(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows (id, cluster, distance) of a chunk; a distance beyond a long is null."""
    labels, distances = nearest(rows["part"])
    ids = next(ids for ids in rows["ids"] if ids is not None)
    return pd.DataFrame(
        {
            "id": pd.array([None if pd.isna(i) else int(i) for i in ids], "Int64"),
            "cluster": labels.astype(np.int32),
            "distance": pd.array([int(d) if int(d) <= LARGEST else None for d in distances], "Int64"),
        }
    )


def lloyd(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, shard: int = SHARD, chunk: int = CHUNK,
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, cluster, distance) of every kept vector, and the final centroids as whole numbers.

    Vectors that are null, of another length, or hold null or non-finite components (also once
    scaled by 256 as doubles) take no part. Large finite components are calculated in integers of any
    size; a distance that no long can hold is null. Repeated rows are vectors of their own; a null id
    is kept. With fewer vectors than clusters every vector starts one; an empty table gives no rows
    and no centroids. Other columns of the table are not read.
    """
    centroids = starting_centroids(vectors, id_col, vector_col, dimensions, clusters, seed)
    spark = vectors.sparkSession
    if not len(centroids):
        return spark.createDataFrame([], "id long, cluster int, distance long"), centroids
    blocks = stored(column_blocks(vectors, id_col, vector_col, dimensions, shard, chunk), "column-blocks")
    for _ in range(rounds):
        grouped = with_partials(blocks, centroids, shard).groupBy("chunk")
        sums = grouped.applyInPandas(chunk_sums(shard, len(centroids)), "cluster int, dimension int, level int, total long")
        centroids = updated(centroids, sums)
    final = with_partials(blocks, centroids, shard).groupBy("chunk").applyInPandas(assigned, "id long, cluster int, distance long")
    return stored(final, "clusters"), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assignments with the inertia of their cluster and of all, and their centroid's sha256.

    An inertia that no long can hold, or that holds a distance without a number, is null.
    """
    spark = found.sparkSession
    facts = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("unknown")
    )
    totals = {r["cluster"]: None if r["unknown"] else int(r["total"]) for r in facts.collect()}
    overall = None if None in totals.values() else sum(totals.values())
    fit = lambda n: n if n is not None and n <= LARGEST else None
    rows = []
    for cluster, total in totals.items():
        name = hashlib.sha256(",".join(str(int(x)) for x in centroids[cluster]).encode()).hexdigest()
        rows.append((cluster, fit(total), fit(overall), name))
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row per cluster.
    return found.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster")
