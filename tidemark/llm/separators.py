"""Token counts of documents in flat token files, by a scan for separators.

A flat file is nothing but token ids, document after document, each ended by one separator id; there
is no index. Files are read in blocks. Each block is searched for separators at once (numpy), which
gives the lengths between them and the open pieces at its two ends; a prefix scan over the blocks'
summaries numbers the documents and joins the pieces of documents that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import word_encoder
from tidemark.runtime import stored

BLOCK_TOKENS = 1 << 20
VOCABULARY = "word_bpe_49k.json"
SEPARATOR = 49_407
# Blocks of a file are first added up in groups of this many.
GROUP = 1_024
# Parts of words whose ids a worker keeps, beside the blocks it fills.
CACHED_WORDS = 300_000


def read_flat(spark: SparkSession, path: str, token_bytes: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows (file, block, content): flat token files cut in blocks; the last one may be shorter.

    A file is one row while it is cut, so files should stay below some hundred megabytes.
    """
    size = block_tokens * token_bytes
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "length", "content")
    cut = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))))
    begin = (F.col("block") * size + 1).cast("int")
    return cut.select("file", "block", F.substring("content", begin, F.lit(size)).alias("content"))


def flat_streams(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
    separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Rows (file, block, content, ids): each partition's documents as one flat stream of 16-bit ids, cut in blocks.

    ``ids`` are those of the documents that end in the block, in order: what a writer of flat files
    would keep aside. Text that spells a special token is ordinary text, so only ends are separators.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary, special_as_text=True, cached=CACHED_WORDS)
        waiting, held, ended, block, file = [], 0, [], 0, None

        def emit(tokens: np.ndarray, ids: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([block], pa.int64()),
                    pa.array([tokens.astype("<u2").tobytes()], pa.binary()),
                    pa.array([ids], pa.list_(pa.int64())),
                ],
                ["file", "block", "content", "ids"],
            )

        for whole in batches:
            for begin in range(0, whole.num_rows, 1_024):
                batch = whole.slice(begin, 1_024)
                file = batch.column(2)[0].as_py()
                keys = batch.column(0).to_pylist()
                for key, ids in zip(keys, encoder.encode([t or "" for t in batch.column(1).to_pylist()])):
                    left = np.append(ids, np.uint32(separator)).astype("<u2")
                    while len(left):
                        part = left[: block_tokens - held]
                        waiting.append(part)
                        held, left = held + len(part), left[len(part) :]
                        if not len(left):
                            ended.append(key)
                        if held == block_tokens:
                            yield emit(np.concatenate(waiting), ended)
                            waiting, held, ended, block = [], 0, [], block + 1
        if held:
            yield emit(np.concatenate(waiting), ended)

    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("file")
    )
    return chosen.mapInArrow(run, "file int, block long, content binary, ids array<long>")


def block_counts(blocks: DataFrame, separator: int, token_bytes: int) -> DataFrame:
    """Rows (file, block, ends, lengths, tail): tokens before each separator since the last one, and after the last."""
    kind = {1: "<u1", 2: "<u2", 4: "<u4"}[token_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, tails = [], []
            for content in batch.column("content").to_pylist():
                tokens = np.frombuffer(content or b"", kind)
                at = np.flatnonzero(tokens == separator)
                lengths.append(np.diff(at, prepend=-1) - 1)
                tails.append(len(tokens) - (int(at[-1]) + 1 if len(at) else 0))
            kept = [batch.column("file"), batch.column("block"), pa.array([len(n) for n in lengths], pa.int64())]
            arrays = [*kept, pa.array([n.tolist() for n in lengths], pa.list_(pa.int64())), pa.array(tails, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "ends", "lengths", "tail"])

    file = blocks.schema["file"].dataType.simpleString()
    return blocks.select("file", "block", "content").mapInArrow(
        run, f"file {file}, block long, ends long, lengths array<long>, tail long"
    )


def stitched(counts: DataFrame) -> DataFrame:
    """``counts`` with (first, carried): documents ended before the block, and open tokens that reach into it.

    The scan has two levels: inside groups of blocks, and over one row per group.
    """
    grouped = counts.withColumn("part", F.floor(F.col("block") / GROUP))
    inner = Window.partitionBy("file", "part").orderBy("block")
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    # Tokens open after a block: its tail, and if it has no end also what was open before it.
    ended = F.when(F.col("ends") > 0, F.col("block"))
    level = grouped.select(
        "file", "part", "block", "ends", "tail", "lengths",
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("ends_before"),
        F.coalesce(F.sum("tail").over(before), F.lit(0)).alias("tails_before"),
        F.last(ended, ignorenulls=True).over(before).alias("last_end"),
    )
    # Tails summed up to, but without, the block of the last end.
    at_end = F.when(F.col("ends") > 0, F.col("tails_before"))
    level = level.withColumn("tails_at_end", F.last(at_end, ignorenulls=True).over(before))
    groups = level.groupBy("file", "part").agg(
        F.sum("ends").alias("group_ends"),
        F.sum("tail").alias("group_tails"),
        F.max_by(F.col("tails_before"), F.when(F.col("ends") > 0, F.col("block"))).alias("group_at_end"),
    )
    outer = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = groups.withColumn("sum_tails", F.coalesce(F.sum("group_tails").over(outer), F.lit(0)))
    sums = sums.withColumn("sum_ends", F.coalesce(F.sum("group_ends").over(outer), F.lit(0)))
    open_from = F.when(F.col("group_ends") > 0, F.col("sum_tails") + F.col("group_at_end"))
    sums = sums.withColumn("open_from", F.coalesce(F.last(open_from, ignorenulls=True).over(outer), F.lit(0)))
    joined = level.join(sums.select("file", "part", "sum_ends", "sum_tails", "open_from"), ["file", "part"])
    start = F.when(F.col("last_end").isNotNull(), F.col("sum_tails") + F.col("tails_at_end")).otherwise(F.col("open_from"))
    return joined.select(
        "file", "block", "ends", "lengths", "tail",
        (F.col("sum_ends") + F.col("ends_before")).alias("first"),
        (F.col("sum_tails") + F.col("tails_before") - start).alias("carried"),
    )


def token_counts(blocks: DataFrame, separator: int = SEPARATOR, token_bytes: int = 2) -> DataFrame:
    """Rows (file, block, document, tokens): every document by the block it ends in, numbered from 0 in its file.

    ``tokens`` leaves the separator out. Blocks are numbered without gaps in a file. An empty or null
    block has no separator and no tokens; two separators in a row end a document without tokens; what
    follows the last separator of a file is not a document. Blocks are unique by (file, block). An
    empty table gives no rows.
    """
    found = stitched(stored(block_counts(blocks, separator, token_bytes), "blocks"))
    return found.select("file", "block", "first", "carried", F.posexplode("lengths").alias("i", "inside")).select(
        "file",
        "block",
        (F.col("first") + F.col("i")).alias("document"),
        (F.col("inside") + F.when(F.col("i") == 0, F.col("carried")).otherwise(0)).alias("tokens"),
    )


def document_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, tokens): documents laid down as flat files, scanned for separators, and named again.

    Null and empty texts have 0 tokens. Rows with null ids and repeated rows are counted like others.
    An empty table gives no rows; other columns are not read.
    """
    streams = stored(flat_streams(docs, id_col, text_col), "flat")
    counts = token_counts(streams)
    # The n-th document that ends in a block is the n-th of its ids.
    names = streams.select("file", "block", F.posexplode("ids").alias("n", "doc_id"))
    order = counts.groupBy("file", "block").agg(F.min("document").alias("least"))
    placed = counts.join(order, ["file", "block"]).withColumn("n", (F.col("document") - F.col("least")).cast("int"))
    return placed.join(names, ["file", "block", "n"]).select("doc_id", "tokens")
