"""Packing by the length histogram, shortest pack first.

Documents become pieces of at most one sequence. The histogram of piece lengths has at most
``sequence`` entries, so packing patterns are found on it alone: lengths are placed longest first,
always into the packs that are shortest so far, whole counts of packs at a time. Pieces then find
their pack by their rank among the pieces of equal length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import word_encoder
from tidemark.runtime import stored

SEQUENCE = 2_048
VOCABULARY = "word_bpe_49k.json"
# Pieces of one length are ranked in this many shares.
SHARES = 64


class Pattern(NamedTuple):
    """``count`` equal packs: the lengths that each holds, in the order of placing."""

    count: int
    lengths: tuple[int, ...]


def patterns(histogram: dict[int, int], sequence: int) -> list[Pattern]:
    """Packing patterns for a histogram of lengths, longest length first, shortest pack first.

    A length goes to the packs with the most room (the shortest ones), as many as there are; if
    even these have too little, new packs are opened. Packs of equal content stay one pattern.
    """
    open_packs: dict[int, list[Pattern]] = {}
    rooms: list[int] = []
    done: list[Pattern] = []

    def put(pattern: Pattern) -> None:
        room = sequence - sum(pattern.lengths)
        if not room:
            done.append(pattern)
            return
        if room not in open_packs:
            open_packs[room] = []
            insort(rooms, room)
        open_packs[room].append(pattern)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                fit = sequence // length
                whole, rest = divmod(left, fit)
                if whole:
                    put(Pattern(whole, (length,) * fit))
                if rest:
                    put(Pattern(1, (length,) * rest))
                break
            room = rooms[-1]
            pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
                rooms.pop(bisect_left(rooms, room))
            fit = room // length
            whole = min(left // fit, pattern.count)
            if whole:
                put(Pattern(whole, pattern.lengths + (length,) * fit))
                left -= whole * fit
            spare = pattern.count - whole
            if spare and left:  # fewer than one pack takes
                put(Pattern(1, pattern.lengths + (length,) * left))
                spare, left = spare - 1, 0
            if spare:
                put(Pattern(spare, pattern.lengths))
    return done + [pattern for room in rooms for pattern in open_packs[room]]


def token_pieces(
    docs: DataFrame, id_col: str, text_col: str, sequence: int, vocabulary: str, end_id: int, with_ids: bool
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document cut after every ``sequence`` ids."""
    schema = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1_024):
                batch = whole.slice(begin, 1_024)
                keys, rows = batch.column(0).to_pylist(), []
                every, ends = encoder.encode_array(batch.column(1))
                for key, begin_at, end_at in zip(keys, [0, *ends[:-1].tolist()], ends.tolist()):
                    ids = np.append(every[begin_at:end_at], np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), sequence):
                        piece = ids[start : start + sequence]
                        row = (key, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                        rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                if not rows:
                    continue
                columns = list(zip(*rows))
                arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())]
                arrays += [pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())]
                arrays += [pa.array(columns[5], pa.list_(pa.int32()))] if with_ids else []
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, schema)


def placed(pieces: DataFrame, found: list[Pattern], shares: DataFrame) -> DataFrame:
    """Join pieces with their packs: rank within the length, then the pattern slot that holds the rank.

    The slots of a length lie one after the other on its ranks. There are few of them, whatever the
    number of pieces: patterns arise only from lengths, at most ``sequence`` of them.
    """
    slots: dict[int, list[tuple[int, int, int]]] = {}
    filled: dict[int, int] = {}
    first_id = 0
    for pattern in found:
        offset = 0
        for length in pattern.lengths:
            begin = filled.get(length, 0)
            slots.setdefault(length, []).append((begin, first_id, offset))
            filled[length] = begin + pattern.count
            offset += length
        first_id += pattern.count
    table = {length: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for length, rows in slots.items()}
    shared = pieces.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            ids, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                begins, firsts, places = own[int(length)]
                here = np.flatnonzero(lengths == length)
                slot = np.searchsorted(begins, ranks[here], side="right") - 1
                ids[here] = firsts[slot] + ranks[here] - begins[slot]
                offsets[here] = places[slot]
            kept = [name for name in batch.schema.names if name not in ("rank", "share", "length")]
            arrays = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(lengths.astype(np.int64)), pa.array(ids), pa.array(offsets)],
                [*kept, "length", "sequence_id", "offset"],
            )

    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = shares.withColumn("begin", F.coalesce(F.sum("count").over(before), F.lit(0))).select("length", "share", "begin")
    within = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("number", F.row_number().over(within).cast("long"))
        .join(F.broadcast(starts), ["length", "share"])
        .withColumn("rank", F.col("begin") + F.col("number") - 1)
        .drop("begin", "number")
    )
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name not in ("rank", "share", "length"))
    return ranked.mapInArrow(place, f"{kept}, length long, sequence_id long, offset long")


def share_of(column: str) -> Column:
    return F.pmod(F.xxhash64(column, "start"), F.lit(SHARES)).cast("int")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    vocabulary: str = VOCABULARY,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Rows (doc_id, start, ids_crc32, doc_tokens[, ids], length, sequence_id, offset), one per piece.

    Every document is its ids and then ``end_id``; null and empty texts are that id alone. A piece
    is at most ``sequence`` ids; the pieces of a sequence lie from 0 without gaps and never exceed it.
    Rows with a null id and repeated rows are packed like others (equal pieces take neighbouring
    ranks, so the result does not depend on their order). An empty table gives no rows. Other columns
    are not read.
    """
    made = token_pieces(docs, id_col, text_col, sequence, vocabulary, end_id, with_ids)
    pieces = stored(made.withColumn("share", share_of("doc_id")), "pieces")
    # At most sequence x SHARES rows, whatever the number of pieces.
    shares = stored(pieces.groupBy("length", "share").count(), "shares")
    histogram = {row["length"]: row["pieces"] for row in shares.groupBy("length").agg(F.sum("count").alias("pieces")).collect()}
    return placed(pieces, patterns(histogram, sequence), shares)


