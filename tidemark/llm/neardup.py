"""Near duplicates by SimHash over word shingles, joined by the generalised pigeonhole principle.

Bits that agree often are grouped into partitions of the fingerprint. Partition i gets a threshold
t_i with sum(t_i) = radius - partitions + 1 (a threshold of -1 leaves a partition out): two
fingerprints within the radius then agree up to t_i in at least one partition. The thresholds come
from dynamic programming over candidate counts estimated on a bounded sample of fingerprints; they
decide how much work is done, never which links are found. Fingerprints are probed with every value
within t_i of their own part and each candidate is verified on all 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.links import linked
from tidemark.runtime import bucketed, handed_on, lifetime, stored, unused_names

BITS = 64
# The thresholds are fitted on at most this many distinct fingerprints.
FIT_SAMPLE = 2_000
# A partition is probed with at most this many values for each fingerprint.
PROBES = 1_024


def fingerprint(text: str | None, words: int) -> int:
    """Majority of the XXH64 hashes of all word shingles, repeats included; 0 without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(lengths) - 1
        starts = (ends - lengths + 1)[: len(parts) - words + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist())]
    votes = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 65_536):
        block = np.array(hashes[begin : begin + 65_536], dtype="<u8")
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint as a signed 64-bit number. Null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


def grouped_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits divided into parts of nearly equal size; each part collects the bits most correlated with it."""
    if len(sample) < 8:
        return [list(range(BITS))[i::parts] for i in range(parts)]
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    centred = bits - bits.mean(0)
    spread = np.sqrt((centred**2).mean(0)) + 1e-9
    alike = np.abs((centred / spread).T @ (centred / spread)) / len(sample)
    free, found = set(range(BITS)), []
    for part in range(parts):
        room = (BITS * (part + 1)) // parts - (BITS * part) // parts
        seed = max(sorted(free), key=lambda bit: alike[bit, sorted(free)].sum())
        own = [seed]
        free.discard(seed)
        while len(own) < room:
            best = max(sorted(free), key=lambda bit: alike[bit, own].sum())
            own.append(best)
            free.discard(best)
        found.append(sorted(own))
    return found


def allotted(sample: np.ndarray, groups: list[list[int]], radius: int, rows: int) -> tuple[float, list[int]]:
    """Thresholds with the lowest estimated work, by dynamic programming over the partitions.

    The work of threshold t in a partition is the rows probed (every value within t) and the
    candidates expected among ``rows`` fingerprints, from the sample's distances in that partition.
    """
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    budget = radius - len(groups) + 1
    never = (float("inf"), [])
    best = {0: (0.0, [])}
    for group in groups:
        mask = np.uint64(sum(1 << bit for bit in group))
        near = np.zeros(radius + 2)
        for begin in range(0, len(sample), 256):
            block = np.bitwise_count((sample[begin : begin + 256, None] ^ sample[None, :]) & mask)
            near += [(block <= t).sum() for t in range(-1, radius + 1)]
        ahead: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, radius + 1):
                probes = sum(comb(len(group), k) for k in range(t + 1))
                if probes > PROBES:
                    continue
                # Unseen closeness is floored by what uniform bits would give.
                share = max((near[t + 1] - len(sample)) / 2 / pairs, probes / 2.0 ** len(group)) if t >= 0 else 0.0
                total = cost + (probes + (t >= 0)) * rows + share * rows * (rows - 1) / 2 * 0.1
                if spent + t not in ahead or total < ahead[spent + t][0]:
                    ahead[spent + t] = (total, [*chosen, t])
        best = ahead
    return best.get(budget, never)


def plan(sample: np.ndarray, radius: int, rows: int) -> tuple[list[list[int]], list[int]]:
    """The partitions and thresholds with the least estimated work, over several numbers of partitions."""
    options = []
    for parts in range(2, radius + 2):
        groups = grouped_bits(sample, parts)
        options.append((*allotted(sample, groups, radius, rows), groups))
    _, thresholds, groups = min(options, key=lambda option: option[0])
    return groups, thresholds


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def close_pairs(prints: DataFrame, radius: int, sample_rows: int = FIT_SAMPLE) -> DataFrame:
    """Pairs (one, two, distance), one < two, of the distinct values in ``fp`` within the radius; each pair once.

    ``prints`` must hold every value once and no null. The fit reads a bounded sample (lowest
    hashes); index and probes hold every fingerprint.
    """
    rows = prints.count()
    picked = prints.orderBy(F.xxhash64(F.lit(7), "fp"), "fp").limit(sample_rows).collect()
    sample = np.array([row["fp"] for row in picked], dtype=np.int64).view(np.uint64)
    groups, thresholds = plan(sample, radius, rows)
    masks = [signed(sum(1 << bit for bit in group)) for group in groups]
    kept = [part for part, t in enumerate(thresholds) if t >= 0]
    flips = [
        F.array(
            *[
                F.struct(F.lit(part).alias("part"), F.lit(signed(sum(1 << b for b in chosen))).alias("flip"))
                for size in range(thresholds[part] + 1)
                for chosen in combinations(groups[part], size)
            ]
        )
        for part in kept
    ]
    own = F.array(*[F.struct(F.lit(p).alias("part"), F.col("fp").bitwiseAND(F.lit(masks[p])).alias("part_key")) for p in kept])
    index = prints.select(F.col("fp").alias("two"), F.inline(own))
    mask_of = F.coalesce(*[F.when(F.col("part") == p, F.lit(masks[p])) for p in kept])
    probes = prints.select(F.col("fp").alias("one"), F.inline(F.concat(*flips))).select(
        "one", "part", F.col("one").bitwiseAND(mask_of).bitwiseXOR(F.col("flip")).alias("part_key")
    )
    apart = F.col("one").bitwiseXOR(F.col("two"))
    within = [F.bit_count(apart.bitwiseAND(F.lit(masks[p]))) <= thresholds[p] for p in kept]
    # A pair that several partitions find belongs to the first of them.
    first = F.coalesce(*[F.when(hit, F.lit(p)) for p, hit in zip(kept, within)])
    return (
        probes.alias("probe")
        .join(
            index.alias("index"),
            (F.col("probe.part") == F.col("index.part"))
            & (F.col("probe.part_key") == F.col("index.part_key"))
            & (F.col("one") < F.col("two"))
            & (F.bit_count(apart) <= radius)
            & (first == F.col("probe.part")),
        )
        .select("one", "two", F.bit_count(apart).cast("int").alias("distance"))
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4
) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each row of ``docs``.

    Texts are lower-cased in A-Z and split at ASCII white space. Documents whose fingerprints differ
    in at most ``radius`` bits are linked; ``component_id`` is the smallest doc_id reachable over
    links. Null and empty texts have fingerprint zero and are linked like others. Rows with a null
    id keep it, and get the smallest id of their component (null if it has none). Repeated rows stay
    repeated. Copies are never paired: links are between distinct fingerprints, to which all rows
    are joined back. An empty table gives no rows; other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    linked = components(close_pairs(classes.select("fp"), radius), "one", "two")
    rooted = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    member = rooted.join(smallest, "component").select("fp", "component_id")
    return prints.join(member, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4
) -> DataFrame:
    """``docs`` with its columns, one row for each group of near duplicates: the one with the smallest id.

    Links are those of ``near_duplicates``. Null ids are taken only where a group has no other, equal ids
    go by the hash of the text, and of repeated rows one is kept. Null and empty texts are one group.
    An empty table gives no rows.
    """

    @F.pandas_udf("long")
    def print_of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(text, words) for text in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    keys = ["__print", "__id", "__text"]
    least = -(1 << 63)
    marked = docs.withColumns(
        {
            "__print": print_of(F.col(text_col).cast("string")),
            "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(least)),
            "__text": F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
        }
    )
    order = F.struct(F.col("__id") == least, "__id", "__text")
    classes = stored(marked.groupBy("__print").agg(F.min(order).alias("least")), "classes")
    linked = components(close_pairs(classes.select(F.col("__print").alias("fp")), radius), "one", "two")
    rooted = classes.join(linked.withColumnRenamed("node", "__print"), "__print", "left").withColumn(
        "component", F.coalesce("component", "__print")
    )
    first = rooted.groupBy("component").agg(F.min(F.struct("least", "__print")).alias("first"))
    chosen = first.select(
        F.col("first.__print").alias("__print"), F.col("first.least.__id").alias("__id"), F.col("first.least.__text").alias("__text")
    )
    return marked.dropDuplicates(keys).join(chosen, keys, "left_semi").select(*docs.columns)


# Bits of the fingerprint that the similarity search uses, and how many of them may differ. At similarity 0.8 two prints
# differ in 39 bits on average, texts without common shingles in 128.
WIDE = 256
WIDE_RADIUS = 72
PRINTS = [f"print{k}" for k in range(WIDE // 64)]
# Share of pairs at the least similarity that meet in a table at least.
RECALL = 0.99


def wide_bits(text: str | None, words: int = 5) -> np.ndarray:
    """The bits of a wide SimHash: each is the majority of that bit over the hashes of the distinct word shingles.

    Words are those of ``word_shingles``; a text without words has the hash of no word as its only one.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split() or [b""]
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(part, 42) for part in parts], dtype=np.uint64)
    size = min(words, len(own))
    hashed = np.full(len(own) - size + 1, size, np.uint64)
    for place in range(size):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + own[place : place + len(hashed)]
    hashed = np.unique(hashed)
    ones = np.zeros(WIDE, np.int64)
    for begin in range(0, len(hashed), 255):
        z = hashed[begin : begin + 255, None] + np.arange(1, len(PRINTS) + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = np.ascontiguousarray(z ^ (z >> np.uint64(31)))
        ones += np.unpackbits(z.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return (ones * 2 > len(hashed)).astype(np.uint8)


def tables_for(rows: int, least: float) -> list[np.ndarray]:
    """Places of the bits that each table compares, so many tables that pairs at similarity ``least`` meet in one with RECALL.

    More rows need longer keys, and these more tables; the share of pairs that meet stays. There are at least twice as many
    keys as rows, so that most rows are alone with theirs and what meets by chance stays below the number of rows in each table.
    Two prints at this similarity differ in each bit with probability acos(2 * least / (1 + least)) / pi, or less where the
    sizes differ.
    """
    length = min(30, max(8, rows.bit_length() + 1))
    apart = math.acos(2 * least / (1 + least)) / math.pi
    differing = np.arange(WIDE_RADIUS + 1)
    weights = np.array([comb(WIDE, d) * apart**d * (1 - apart) ** (WIDE - d) for d in differing.tolist()])
    meet = np.prod([(WIDE - differing - i) / (WIDE - i) for i in range(length)], axis=0)
    tables = 8
    while (weights * (1 - (1 - meet) ** tables)).sum() < RECALL:
        tables += 8
    rng = np.random.default_rng(9)
    return [rng.choice(WIDE, length, replace=False) for _ in range(tables)]


def wide_prints(texts: DataFrame, tables: list[np.ndarray], words: int = 5) -> DataFrame:
    """Rows (line_key, bands, print0, ...): the key of each table and the print, of rows (line_key, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            bits = np.array([wide_bits(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint8).reshape(rows, WIDE)
            powers = 1 << np.arange(len(tables[0]), dtype=np.int64)
            keys = np.stack([(number << 32) | (bits[:, places] @ powers) for number, places in enumerate(tables)], axis=1)
            bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, len(tables), dtype=np.int32), keys.reshape(-1))
            longs = np.packbits(bits, axis=1, bitorder="little").view("<i8").reshape(rows, len(PRINTS))
            columns = [pa.array(np.ascontiguousarray(longs[:, k])) for k in range(len(PRINTS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), bands, *columns], ["line_key", "bands", *PRINTS])

    shape = ", ".join(["line_key long", "bands array<long>", *[f"{name} long" for name in PRINTS]])
    return texts.select("line_key", "line").mapInArrow(run, shape)


def wide_close(radius: int = WIDE_RADIUS) -> Column:
    """Whether the prints of both sides differ in at most ``radius`` bits."""
    return sum((F.bit_count(F.col(f"{name}_one").bitwiseXOR(F.col(f"{name}_two"))) for name in PRINTS), F.lit(0)) <= radius


def word_shingles(text: Column | str, words: int = 5) -> Column:
    """The distinct hashes of all runs of words; a text below the length of one has its whole as its only shingle.

    Texts are lower-cased in A-Z and split at ASCII white space, as for ``fingerprint``.
    """
    column = F.col(text) if isinstance(text, str) else text
    lowered = F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.filter(F.split(lowered, "[ \\t\\n\\x0B\\f\\r]+"), lambda word: word != "")

    def runs(parts: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(parts) - words + 1, F.lit(1)))
        return F.transform(starts, lambda start: F.xxhash64(F.slice(parts, start, words)))

    return F.array_distinct(F.element_at(F.transform(F.array(parts), runs), 1))


def one_per_similar_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8
) -> DataFrame:
    """``docs`` with its columns, one row for each group of texts linked by similarity ``least`` or more.

    Similarity is the exact Jaccard of the sets of word shingles. What is compared is picked by SimHash: prints of 256 bits
    that agree in all bits of a table and differ in at most WIDE_RADIUS. Of pairs at similarity ``least`` a share of RECALL
    or more is picked, of closer ones more.
    Texts are known by their 64-bit hash. The row kept is chosen as in ``one_per_group``: the smallest id, null
    ids only where a group has no other, equal ids by the hash of the text, one of repeated rows. Texts without
    words, null ones among them, are one group. An empty table gives no rows.
    """

    def shingles(text: Column | str) -> Column:
        return word_shingles(text, words)

    least_id = -(1 << 63)
    own_id, own_text = keys = unused_names(docs, "own_id", "own_text")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.withColumns({own_id: F.coalesce(F.col(id_col).cast("long"), F.lit(least_id)), own_text: F.xxhash64(text)})
    keyed = docs.select(F.xxhash64(text).alias("line_key"), text.alias("line"))
    order = F.struct((F.col(own_id) == least_id).alias("unknown"), F.col(own_id).alias("id"), F.col(own_text).alias("key"))
    classes = marked.groupBy(F.col(own_text).alias("node")).agg(F.min(order).alias("least"))
    distinct = keyed.groupBy("line_key").agg(F.first("line").alias("line"))
    with lifetime(docs.sparkSession):
        with bucketed(distinct, "line_key") as texts:
            tables = tables_for(texts.count(), least)
            with bucketed(wide_prints(texts, tables, words), "line_key") as prints:
                bands = [F.col("bands")[number] for number in range(len(tables))]
                alike = linked(texts, prints, bands, PRINTS, wide_close(), least, shingles, passes=3)
        rooted = classes.join(alike, "node", "left").withColumn("component", F.coalesce("component", "node"))
        first = rooted.groupBy("component").agg(F.min("least").alias("first"))
        chosen = handed_on(first.select(F.col("first.id").alias(own_id), F.col("first.key").alias(own_text)), "chosen")
    return marked.dropDuplicates(keys).join(chosen, keys, "left_semi").select(*docs.columns)
