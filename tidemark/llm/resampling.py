"""Importance resampling towards a target distribution of hashed word runs.

Runs of words are hashed into buckets; the corpus and the target texts are counted per bucket, and
the log ratio of their shares is the gain of a bucket. A document's weight is the sum of the gains of
its features, looked up in an array; Gumbel noise from its id makes the highest scores a sample.

Scores are written once. The cutoff is found by numeric bisection: each job counts exactly how many
rows lie above a few thresholds, first of the score, then among the tied rows of the id. The rows
above it are range-partitioned by score and id; ranks are numbers within a range plus the sizes of the
ranges before it. Nothing is sorted as a whole and no group comes to one task.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.runtime import stored

BUCKETS = 10_000
LONGEST_RUN = 1
SEED = 2024
LEAST_WORDS = 20
DRAWN_PERCENT = 10
# Thresholds that one counting job tries.
SECTIONS = 32
# Bytes of a text that are split into words at one time.
PIECE = 1 << 20
# Features whose bucket a task keeps in mind.
CACHED = 500_000

# Lower-case A-Z; every other ASCII character that is no digit or lower-case letter ends a word.
FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)

SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


class Bucket(dict):
    """Bucket of a feature, remembered for a bounded number of them."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def word_pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """Words of a whole text, some at a time; a piece ends where a word ends."""
    folded = (text or b"").translate(FOLD)
    begin = 0
    while begin < len(folded):
        cut = folded.find(b" ", begin + PIECE)
        end = len(folded) if cut < 0 else cut
        yield folded[begin:end].split()
        begin = end


def feature_buckets(text: bytes | None, bucket: Bucket, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and buckets of the runs of 1 to ``longest`` words that end in each piece of a text."""
    tail: list[bytes] = []
    for words in word_pieces(text):
        found = [np.fromiter(map(bucket.__getitem__, words), np.int64, len(words))]
        line = tail + words
        for size in range(2, longest + 1):
            first = max(len(tail) + 1 - size, 0)
            runs = [b" ".join(line[i : i + size]) for i in range(first, len(line) - size + 1)]
            found.append(np.fromiter(map(bucket.__getitem__, runs), np.int64, len(runs)))
        tail = line[-(longest - 1) :] if longest > 1 else []
        yield len(words), np.concatenate(found)


def bucket_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """Features of all texts per bucket; every task sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, counts = Bucket(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py(), bucket, longest):
                    counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("string").cast("binary")).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed shares of each bucket."""
    buckets = len(corpus)
    all_corpus, all_target = int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_corpus + buckets) / ((s + 1) * (all_target + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Whole Gumbel noise of an id; a null id is as empty text."""
    name = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(name[:8], 16) + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, longest: int, seed: int) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Bucket(len(gains))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = features = weight = 0
                for n, found in feature_buckets(text.as_py(), bucket, longest):
                    words, features, weight = words + n, features + len(found), weight + int(gains[found].sum())
                rows.append((doc_id, words, features, weight, weight + noise(doc_id, seed)))
            columns = zip(*rows) if rows else [[]] * 5
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")).mapInArrow(run, SCORED)


def kth_largest(rows: DataFrame, key: str, wanted: int) -> tuple[int, int, int]:
    """The ``wanted``-th largest value of a long column, how many rows lie above it and how many hold it.

    Bisection with SECTIONS parts: each job counts the rows at or above its thresholds, exactly.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    # At least ``wanted`` rows hold ``low`` or more; fewer than that hold ``high`` + 1 or more.
    high += 1
    while high - low > 1:
        steps = min(SECTIONS, high - low)
        tried = sorted({low + (high - low) * i // steps for i in range(1, steps)} - {low, high})
        counts = rows.agg(*[F.count_if(F.col(key) >= F.lit(t).cast("long")).alias(f"c{i}") for i, t in enumerate(tried)]).first()
        enough = [t for t, n in zip(tried, counts) if n >= wanted]
        few = [t for t, n in zip(tried, counts) if n < wanted]
        low, high = max([low, *enough]), min([high, *few])
    above, holding = rows.agg(F.count_if(F.col(key) > low), F.count_if(F.col(key) == low)).first()
    return low, above, holding


def highest(rows: DataFrame, keys: list[str], wanted: int) -> Column:
    """Condition that exactly ``wanted`` rows meet: the highest by the long columns ``keys``, the last of them unique."""
    condition, tied = F.lit(False), F.lit(True)
    for key in keys:
        if wanted <= 0:
            break
        value, above, holding = kth_largest(rows.where(tied), key, wanted)
        value = F.lit(value).cast("long")
        condition = condition | (tied & (F.col(key) > value))
        tied = tied & (F.col(key) == value)
        wanted -= above
        if wanted == holding:
            return condition | tied
    return condition


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    buckets: int = BUCKETS, longest: int = LONGEST_RUN, least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score, rank) of every document; rank is null where it is not drawn.

    Drawn are floor(percent * N / 100) of the N documents with ``least_words`` words or more, by score,
    then by smaller id (null last), then by more features. Repeated rows that agree in all of these
    are told apart by a row number. Null and empty texts have no features and weight 0. An empty
    table gives no rows; without target texts every feature counts as equally unseen. Texts of any
    length are read whole, a piece at a time. Other columns are not read.
    """
    corpus = bucket_counts(docs, text_col, buckets, longest)
    gains = bucket_gains(corpus, bucket_counts(target, target_col, buckets, longest))
    scored = weighted(docs, gains, id_col, text_col, longest, seed)
    lowest = -(1 << 63)
    rows = stored(
        scored.withColumn("low_id", F.coalesce(F.bitwise_not("doc_id"), F.lit(lowest))).withColumn("row", F.monotonically_increasing_id()),
        "scores",
    )
    able = F.col("n_words") >= least_words
    eligible = rows.where(able)
    keys = ["score", "low_id", "n_features", "row"]
    drawn = able & highest(eligible, keys, percent * eligible.count() // 100)
    order = [F.col(key).desc() for key in keys]
    ranges = stored(rows.where(drawn).repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "drawn")
    # One number per range.
    sizes = sorted(tuple(r) for r in ranges.groupBy("range").count().collect())
    before = np.concatenate(([0], np.cumsum([n for _, n in sizes])))
    offsets = [(part, int(n)) for (part, _), n in zip(sizes, before)]
    starts = rows.sparkSession.createDataFrame(offsets, "range int, before long")
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = ranges.join(F.broadcast(starts), "range").withColumn("rank", (F.col("before") + inside).cast("long"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    left = rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(columns).unionByName(left.select(columns))
