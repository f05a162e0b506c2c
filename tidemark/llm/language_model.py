"""Language-model scoring by a weighted backoff automaton.

Runs of up to ORDER tokens of the training texts become the arcs of an automaton: a state is the
context read last, an arc carries the smoothed log-probability of a token and leads to the longest
context that ends with it, and a failure arc leads to the context without its first token, with the
weight of backing off. A text is read once from left to right, carrying the state and adding up.

Smoothing is a Dirichlet prior around the next shorter context: with c(h) training tokens after h and
c(hw) of them w, P(w|h) = (c(hw) + m P(w|h')) / (c(h) + m). An unseen w takes the failure arc of
weight m / (c(h) + m). The empty context has additive smoothing with one unseen class, so all
probabilities of a context sum to one.

The model grows with the corpus and is never in one place. Documents are dealt to blocks; a block
asks for its own distinct runs. Runs meet by hash range, where the counts of all blocks are added up,
and the totals return to the blocks, each of which builds the part of the automaton it can reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import bucketed, stored

# Longest run of tokens, its last one included.
ORDER = 3
# Strength of the prior for contexts of one token, two tokens and so on.
PRIOR = (1000.0, 10.0, 10.0)
# Added to the count of every token and of the unseen class.
ADDED = 0.1
# Tokens of a piece (long texts are read in pieces that know the tokens before) and of a block.
PIECE = 4_096
BLOCK = 1_500_000
# Bits that a run of two or more tokens is known by; words have 64.
RUN_BITS = 56
# Bytes of a text split into words at one time.
WINDOW = 1 << 20
# Asked runs that meet in one task, about.
MEETING = 4_000_000

# Tokens that no word can be: the end of a text, and what stands before its first word.
END, BEGIN = b" end", b" begin"
# Lower-case A-Z; the bytes 9 to 13 separate words as a space does.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if 9 <= c <= 13 else c for c in range(256))

BLOCKS = (
    "block long, n long, hashes binary, tokens binary, before binary, length binary, held binary, row array<long>, id array<long>"
)


class Numbers(dict):
    """Number of a word in its block, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def text_pieces(text: bytes | None, order: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Tokens of a whole text in pieces, each with the tokens before it; the last piece holds the end."""
    folded = (text or b"").translate(FOLD)
    context, pending, begin = [BEGIN], [], 0
    while begin < len(folded):
        cut = folded.find(b" ", begin + WINDOW)
        end = len(folded) if cut < 0 else cut
        pending += folded[begin:end].split()
        begin, whole = end, len(pending) // PIECE * PIECE
        for at in range(0, whole, PIECE):
            words = pending[at : at + PIECE]
            yield context, words
            context = words[-(order - 1) :] if order > 1 else [BEGIN]
        pending = pending[whole:]
    yield context, [*pending, END]


def blocks_of(docs: DataFrame, id_col: str, text_col: str, held: Column, order: int) -> DataFrame:
    """Pieces of all documents in blocks: numbers of their tokens, hashes of the words, and whose they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        row, block = (task << 40) - 1, (task << 32) - 1

        def empty():
            return Numbers({END: 0, BEGIN: 1}), [], [], [], [], [], [], 0

        def batch_of(numbers, tokens, before, length, trained, rows, ids, n):
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(word) for word in numbers), np.uint64, len(numbers))
            binary = [
                hashes.tobytes(),
                planes(np.concatenate(tokens)),
                *[np.array(part, kind).tobytes() for part, kind in ((before, np.int32), (length, np.int32), (trained, np.int8))],
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([n], pa.int64()),
                    *[pa.array([part], pa.binary()) for part in binary],
                    pa.array([rows], pa.list_(pa.int64())),
                    pa.array([ids], pa.list_(pa.int64())),
                ],
                ["block", "n", "hashes", "tokens", "before", "length", "held", "row", "id"],
            )

        state = empty()
        for batch in batches:
            for doc_id, text, out in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                row += 1
                for context, words in text_pieces(text.as_py(), order):
                    numbers, tokens, before, length, trained, rows, ids, n = state
                    found = context + words
                    tokens.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                    before.append(len(context))
                    length.append(len(words))
                    trained.append(out)
                    rows.append(row)
                    ids.append(doc_id)
                    state = (*state[:-1], n + len(words))
                    if state[-1] >= BLOCK:
                        block += 1
                        yield batch_of(*state)
                        state = empty()
        if state[-1]:
            block += 1
            yield batch_of(*state)

    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"), held.alias("held"))
    return texts.mapInArrow(run, BLOCKS)


class Runs(NamedTuple):
    """Distinct runs of one length in a block."""

    prefix: np.ndarray  # number of the run without its last token, among the runs one shorter
    last: np.ndarray  # number of the last token
    hashed: np.ndarray
    trained: np.ndarray  # how often it ends in a training token of the block


class Block(NamedTuple):
    tokens: np.ndarray
    starts: np.ndarray  # where each piece starts, its context included
    before: np.ndarray
    length: np.ndarray
    held: np.ndarray
    runs: list[Runs]
    suffix: list[np.ndarray]  # per length: number of the run without its first token


def mixed(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a run from those of its prefix and its last token."""
    found = prefix * np.uint64(0x9E3779B97F4A7C15) + word
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(29)
    # Low bits of zero cost nothing where sorted hashes are packed.
    return found >> np.uint64(64 - RUN_BITS) << np.uint64(64 - RUN_BITS)


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the number of each code among them."""
    order = np.argsort(codes)
    ranked = codes[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(codes)]
    number = np.empty(len(codes), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return ranked[new], number


def read_block(row: pd.Series, order: int) -> Block:
    """A block and all its runs; equal for equal rows, so that asking and scoring number runs alike."""
    hashes = np.frombuffer(row["hashes"], np.uint64)
    tokens = from_planes(row["tokens"]).astype(np.int32)
    before, length = np.frombuffer(row["before"], np.int32), np.frombuffer(row["length"], np.int32)
    held = np.frombuffer(row["held"], np.int8).astype(bool)
    sizes = before + length
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(len(tokens), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
    learned = (place >= np.repeat(before, sizes)) & np.repeat(~held, sizes)
    size = len(hashes)
    count = np.bincount(tokens[learned], minlength=size)
    runs = [Runs(np.zeros(size, np.int32), np.arange(size, dtype=np.int32), hashes, count)]
    suffix = [np.zeros(size, np.int32)]
    ending = tokens
    for longer in range(2, order + 1):
        valid = np.flatnonzero(place >= longer - 1).astype(np.int32)
        codes, number = distinct(ending[valid - 1].astype(np.int64) * size + tokens[valid])
        prefix, last = (codes // size).astype(np.int32), (codes % size).astype(np.int32)
        trained = np.bincount(number[learned[valid]], minlength=len(codes)).astype(np.int32)
        runs.append(Runs(prefix, last, mixed(runs[-1].hashed[prefix], hashes[last]), trained))
        # The run without its first token ends at the same place.
        shorter = np.zeros(len(codes), np.int32)
        shorter[number] = ending[valid]
        suffix.append(shorter)
        ending = np.full(len(tokens), -1, np.int32)
        ending[valid] = number
    return Block(tokens, starts, before, length, held, runs, suffix)


def planes(numbers: np.ndarray) -> bytes:
    """Packed whole numbers: the lowest byte of all first, so that high bytes are runs of zeros to the compressor."""
    data = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def from_planes(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], 8 * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, size).T).view("<u8").ravel()


def hash_ranges(hashed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the hashes and where each of the 2**bits ranges begins in it."""
    order = np.argsort(hashed, kind="stable")
    edges = np.array([i << (64 - bits) for i in range(1, 1 << bits)], np.uint64) if bits else np.zeros(0, np.uint64)
    inner = np.searchsorted(hashed[order], edges)
    return order, np.concatenate(([0], inner, [len(hashed)]))


CELLS = "block long, size int, part long, asked binary, payload binary"


def asked(blocks: DataFrame, bits: int, order: int) -> DataFrame:
    """Rows (block, size, part, payload): sorted hashes and training counts of the distinct runs of a block, by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                for size, runs in enumerate(read_block(row, order).runs, 1):
                    by_hash, edges = hash_ranges(runs.hashed, bits)
                    rows = []
                    for part in np.flatnonzero(np.diff(edges)):
                        chosen = by_hash[edges[part] : edges[part + 1]]
                        keys = runs.hashed[chosen]
                        steps = np.diff(keys, prepend=np.uint64(0))
                        rows.append((row["block"], size, int(part), planes(steps), planes(runs.trained[chosen])))
                    if not rows:
                        continue
                    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, ["block", "size", "part", "asked", "payload"])

    return blocks.select("block", "hashes", "tokens", "before", "length", "held").mapInArrow(run, CELLS)


ANSWERS = "block long, size int, part long, payload binary, seen long, total long"


def answered(cells: pd.DataFrame) -> pd.DataFrame:
    """Totals over all blocks for each cell of one hash range, in the order asked, and facts of the range."""
    keys = [np.cumsum(from_planes(steps), dtype=np.uint64) for steps in cells["asked"]]
    sizes = [len(k) for k in keys]
    found, number = distinct(np.concatenate(keys))
    totals = np.zeros(len(found), np.int64)
    np.add.at(totals, number, np.concatenate([from_planes(p) for p in cells["payload"]]).astype(np.int64))
    ends = np.cumsum(sizes)
    first = np.arange(len(cells)) == 0
    return pd.DataFrame(
        {
            "block": cells["block"],
            "size": cells["size"],
            "part": cells["part"],
            "payload": [planes(totals[number[end - size : end]]) for end, size in zip(ends, sizes)],
            # Stated once per range.
            "seen": np.where(first, (totals > 0).sum(), 0),
            "total": np.where(first, totals.sum(), 0),
        }
    )


def automaton(block: Block, counts: list[np.ndarray], seen: int, total: int, prior: tuple[float, ...]) -> tuple[np.ndarray, ...]:
    """Arcs, their weights and targets, failure arcs and their weights, of all that a block can reach.

    State 0 is the empty context; contexts of one token follow, then those of two, up to ORDER - 1.
    """
    order, size = len(block.runs), len(block.runs[0].last)
    first = np.concatenate(([0, 1], 1 + np.cumsum([len(r.last) for r in block.runs])))
    chance = (counts[0] + ADDED) / (total + ADDED * (seen + 1))
    # As many training texts start as end.
    context = counts[0].astype(np.float64)
    context[1] = counts[0][0]
    first = first.astype(np.int32)
    arcs, weight = [np.arange(size)], [np.log10(chance)]
    leads = [first[1] + np.arange(size, dtype=np.int32) if order > 1 else np.zeros(size, np.int32)]
    fails, backoff = [np.zeros(1, np.int32)], [np.zeros(1)]
    for length in range(1, order):
        strength = prior[min(length, len(prior)) - 1]
        runs, suffix = block.runs[length], block.suffix[length]
        fails.append(first[length - 1] + block.suffix[length - 1] if length > 1 else np.zeros(size, np.int32))
        backoff.append(np.log10(strength / (context + strength)))
        chance = (counts[length] + strength * chance[suffix]) / (context[runs.prefix] + strength)
        known = np.flatnonzero(counts[length] > 0)
        arcs.append((first[length] + runs.prefix[known]).astype(np.int64) * size + runs.last[known])
        weight.append(np.log10(chance[known]))
        leads.append(first[length + 1] + known if length + 1 < order else first[length] + suffix[known])
        context = counts[length].astype(np.float64)
    return tuple(map(np.concatenate, (arcs, weight, leads, fails, backoff)))


def traversed(block: Block, machine: tuple[np.ndarray, ...], size: int) -> np.ndarray:
    """Log10 probability of each piece: all pieces are read side by side, one token at a time, each with its state."""
    arcs, weight, leads, fails, backoff = machine
    by_length = np.argsort(-(block.before + block.length), kind="stable")
    starts, before = block.starts[by_length], block.before[by_length]
    ends = (block.before + block.length)[by_length]
    state, score = np.zeros(len(starts), np.int64), np.zeros(len(starts))
    for step in range(int(ends.max(initial=0))):
        live = int(np.searchsorted(-ends, -step, side="left"))
        token = block.tokens[starts[:live] + step]
        counted = step >= before[:live]
        waiting = np.arange(live)
        while len(waiting):
            asked_arc = state[waiting] * size + token[waiting]
            at = np.minimum(np.searchsorted(arcs, asked_arc), len(arcs) - 1)
            found = arcs[at] == asked_arc
            here, at = waiting[found], at[found]
            score[here] += np.where(counted[here], weight[at], 0.0)
            state[here] = leads[at]
            waiting = waiting[~found]
            score[waiting] += np.where(counted[waiting], backoff[state[waiting]], 0.0)
            state[waiting] = fails[state[waiting]]
    back = np.empty(len(starts))
    back[by_length] = score
    return back


PARTS = "row long, id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def scorer(seen: int, total: int, bits: int, order: int, prior: tuple[float, ...]):
    """Scores of the pieces of one block, from the block and the totals of its runs."""

    def run(blocks: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        row = blocks.iloc[0]
        block = read_block(row, order)
        counts = []
        for size, runs in enumerate(block.runs, 1):
            by_hash, _ = hash_ranges(runs.hashed, bits)
            own = cells[cells["size"] == size].sort_values("part")
            count = np.zeros(len(by_hash), np.int64)
            if len(own):
                count[by_hash] = np.concatenate([from_planes(payload) for payload in own["payload"]]).astype(np.int64)
            counts.append(count)
        size = len(block.runs[0].last)
        machine = automaton(block, counts, seen, total, prior)
        block, counts = block._replace(runs=[], suffix=[]), counts[:1]
        score = traversed(block, machine, size)
        real = np.concatenate([np.arange(s + b, s + b + n) for s, b, n in zip(block.starts, block.before, block.length)])
        at = np.concatenate(([0], np.cumsum(block.length)[:-1]))
        known = counts[0][block.tokens[real]]
        base = np.log10((known + ADDED) / (total + ADDED * (seen + 1)))
        return pd.DataFrame(
            {
                "row": row["row"],
                "id": pd.array([None if pd.isna(i) else int(i) for i in row["id"]], "Int64"),
                "held_out": block.held,
                "n_tokens": block.length.astype(np.int64),
                "n_known": np.add.reduceat((known > 0).astype(np.int64), at),
                "base_score": np.add.reduceat(base, at),
                "score": score,
            }
        )

    return run


def scored(
    docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
    prior: tuple[float, ...] = PRIOR,
) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``held`` marks rows that are scored but not learned from. Tokens are the words of the text, A-Z in
    lower case, and one end; null and empty texts have the end alone. Repeated rows are documents of
    their own. ``base_score`` knows single tokens only. Where nothing is learned from, every token is
    the unseen class and scores 0. An empty table gives no rows; texts of any length are read whole,
    in pieces. Other columns are not read. Words are known by 64-bit hashes, longer runs by RUN_BITS: of n
    distinct runs about n**2 / 2**(RUN_BITS + 1) pairs share their totals, 0.07 of 10**8 runs.
    """
    with bucketed(blocks_of(docs, id_col, text_col, held, order), "block") as blocks:
        n_tokens = blocks.agg(F.sum("n")).first()[0] or 0
        bits = max(0, int(n_tokens * order // MEETING).bit_length())
        totals = asked(blocks, bits, order).groupBy("size", "part").applyInPandas(answered, ANSWERS)
        totals = stored(totals, "run-totals")
        facts = totals.where("size = 1").agg(F.sum("seen"), F.sum("total")).first()
        seen, total = facts[0] or 0, facts[1] or 0
        answers = totals.select("block", "size", "part", "payload").groupBy("block")
        parts = blocks.groupBy("block").cogroup(answers).applyInPandas(scorer(seen, total, bits, order, prior), PARTS)
        # Decimals add up to the same in any order.
        exact = lambda name: F.sum(F.col(name).cast("decimal(38,15)")).cast("double").alias(name)
        rows = parts.groupBy("row").agg(
            F.first("id").alias("id"),
            F.first("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            exact("base_score"),
            exact("score"),
        )
        return stored(rows.drop("row"), "lm-scores")
