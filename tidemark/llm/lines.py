"""Fuzzy line de-duplication by MinHash, in DataFrame functions alone.

Equal lines are grouped first. The shingles of a line are its runs of five characters, one at every
position. They are dealt to parts by their hash, MinHash signatures of the parts are banded, lines that
share a band are verified by exact Jaccard similarity, and union-find over the verified links leaves
one line per component, its first occurrence.

Bitmaps of the distinct shingles, made for lines that share a band, bound how much two lines differ, and exact
similarity is computed where the bound allows a link (``links``).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.links import linked
from tidemark.runtime import bucketed, handed_on, lifetime, once, stored, unused_names

# Characters of a shingle.
SHINGLE = 5
# Minima of a band, with few lines, and how many minima there are for each place of a band.
ROWS = 4
HASHES = 8
# A line's shingles are dealt to so many parts by their hash; each part has its share of the minima and bands of its own.
PARTS = 4
# Share of pairs at the least similarity that meet in a band at least: that of 8 bands of 4 at similarity 0.8.
RECALL = 0.985
# Longs of a line's bitmap.
MAP_LONGS = 16
MAPS = [f"map{k}" for k in range(MAP_LONGS)]
LOW_HALF = 0xFFFF_FFFF
# Stands for a null id in joins.
LEAST = -(1 << 63)


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, text_key, line_no, line, line_key): all lines that are not blank, trimmed."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    )
    trimmed = split.withColumn("line", F.trim("line")).where("line <> ''")
    return trimmed.withColumn("line_key", F.xxhash64("line"))


def code_points(line: Column | str) -> Column:
    """The characters of a line in four bytes each, so that any run of them is found without a search."""
    return F.encode(line, "UTF-32")


def places(points: Column | str) -> Column:
    """Where shingles start; a line below the length of one has its whole as its only shingle."""
    return F.sequence(F.lit(0), F.greatest(F.octet_length(points) / 4 - SHINGLE, F.lit(0)).cast("int"))


def shingle_at(points: Column | str, place: Column) -> Column:
    return F.xxhash64(F.substring(points, place * 4 + 1, F.lit(4 * SHINGLE)))


def shingle_hashes(line: Column | str) -> Column:
    # The outer transform encodes the line once, not for every place.
    found = F.transform(F.array(code_points(line)), lambda points: F.transform(places(points), lambda place: shingle_at(points, place)))
    return F.array_distinct(F.element_at(found, 1))


def line_shingles(lines: DataFrame) -> DataFrame:
    """Rows (line_key, h): the hash of each shingle, repeats included."""
    points = lines.select("line_key", code_points("line").alias("points"))
    shingles = points.select("line_key", "points", F.explode(places("points")).alias("place"))
    return shingles.select("line_key", shingle_at("points", F.col("place")).alias("h"))


def bands_for(rows: int, least: float) -> list[list[int]]:
    """Which minima each band compares, for so many distinct lines; pairs at similarity ``least`` meet in one with RECALL.

    Lines of one language have a few shingles in common, and as many pairs of them share a short band as there are lines
    squared. So more lines have longer bands, and these more of them; the share of pairs that meet stays.
    """
    length = max(ROWS, (rows.bit_length() - 3) // 3)
    hashes = HASHES * length // PARTS
    equal = range(hashes + 1)
    weights = [math.comb(hashes, m) * least**m * (1 - least) ** (hashes - m) for m in equal]
    meet = [math.comb(m, length) / math.comb(hashes, length) for m in equal]
    bands = 1
    while 1 - sum(w * (1 - p) ** bands for w, p in zip(weights, meet)) ** PARTS < RECALL:
        bands += 1
    # Bands in turn take what a shuffled round of all minima has left, so that none is used much more than others.
    rng, found, row = np.random.default_rng(5), [], []
    while len(found) < bands:
        row = [*row, *rng.permutation(hashes).tolist()]
        while len(row) >= length and len(found) < bands:
            chosen = list(dict.fromkeys(row))[:length]
            if len(chosen) < length:
                break
            for one in chosen:
                row.remove(one)
            found.append(sorted(chosen))
    # The minima of the parts count on; all parts have the same bands of theirs.
    return [[part * hashes + one for one in band] for part in range(PARTS) for band in found]


def signatures(shingles: DataFrame, bands: list[list[int]]) -> DataFrame:
    """Rows (line_key, part, band0, ...): the hash of each band of minima over the shingles that a line has in a part.

    A shingle takes part in the minima of its own part only. A part without shingles has no row, so that lines do not meet
    by what both lack. Lines of which one part differs more agree the better in the others.
    """
    own = bands[: len(bands) // PARTS]
    part = F.pmod(F.col("h"), F.lit(PARTS)).alias("part")
    hashed = shingles.select("line_key", part, F.col("h").bitwiseAND(F.lit(LOW_HALF)).alias("a"), F.shiftrightunsigned("h", 32).alias("b"))
    hashes = sorted({i for band in own for i in band})
    mixed = [F.min((F.col("a") + F.col("b") * i).bitwiseAND(F.lit(LOW_HALF))).alias(f"m{i}") for i in hashes]
    least = hashed.groupBy("line_key", "part").agg(*mixed)
    return least.select("line_key", "part", *[F.xxhash64(F.lit(b), "part", *[f"m{i}" for i in band]).alias(f"band{b}") for b, band in enumerate(own)])


def parities(lines: DataFrame) -> DataFrame:
    """Rows (line_key, n, map0, ...): a line's number of distinct shingles, and of each bit of its bitmap whether it stands for an odd number of them."""
    shingles = lines.select("line_key", once(shingle_hashes("line")).alias("set")).select("line_key", F.explode("set").alias("h"))
    h = F.col("h")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    # A shingle is counted in its long only; the longs of a line, few, are put side by side afterwards.
    longs = shingles.groupBy("line_key", F.pmod(F.shiftright(h, 6), F.lit(MAP_LONGS)).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(bit).alias("odd"))
    maps = [F.bit_xor(F.when(F.col("k") == k, F.col("odd")).otherwise(0)).alias(f"map{k}") for k in range(MAP_LONGS)]
    return longs.groupBy("line_key").agg(F.sum("n").alias("n"), *maps)


def _missing(side: str, other: str) -> Column:
    """At least so many shingles of one side are not in the other."""
    return sum((F.bit_count(F.col(f"{m}_{side}").bitwiseAND(F.bitwise_not(f"{m}_{other}"))) for m in MAPS), F.lit(0))


def possible(least: float) -> Column:
    """Whether lines of both sides may have similarity ``least``: none that has it is left out.

    Sets A and B of this similarity differ by at most (1 - least) / (1 + least) of |A| + |B| shingles. Each of these
    changes one bit of ``parities``, so no more bits differ; common shingles change none.
    """
    most = (1 - least) / (1 + least) * (F.col("n_one") + F.col("n_two")) + 1e-9

    def differ(maps: list[str]) -> Column:
        return sum((F.bit_count(F.col(f"{m}_one").bitwiseXOR(F.col(f"{m}_two"))) for m in maps), F.lit(0))

    # Most pairs are ruled out by their first longs; the expression stays small enough to be compiled.
    return (differ(MAPS[:4]) <= most) & (differ(MAPS) <= most)


def linked_lines(lines: DataFrame, least: float = 0.8) -> DataFrame:
    """Rows (node, component) of the distinct lines (line_key, line) that are linked to another one."""
    bands = bands_for(lines.count(), least)
    with lifetime(lines.sparkSession):
        prints = stored(signatures(line_shingles(lines), bands), "prints")
        own = [F.col(f"band{b}") for b in range(len(bands) // PARTS)]
        return handed_on(linked(lines, prints, own, ["n", *MAPS], possible(least), least, shingle_hashes, summary=parities), "linked")


def bitmap(shingles: str) -> list[Column]:
    """Columns map0, map1, ...: one of their bits is set for each shingle."""

    def long(k: int) -> Column:
        def add(bits: Column, h: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
            return F.when(F.pmod(F.shiftright(h, 6), F.lit(MAP_LONGS)) == k, bits.bitwiseOR(bit)).otherwise(bits)

        return F.aggregate(shingles, F.lit(0).cast("long"), add).alias(f"map{k}")

    return [long(k) for k in range(MAP_LONGS)]


def _side(members: DataFrame, side: str, *more: str) -> DataFrame:
    # Lines are several times smaller than their sets, which are made where two of them meet.
    kept = ("set",) if "set" in members.columns else ("line", "size")
    return members.select(*[F.col(c).alias(f"{c}_{side}") for c in ("band", "line_key", "component", *kept, *MAPS)], *more)


def _alike(least: float, shingles: Callable[[str], Column] | None) -> Column:
    """Whether the lines of both sides are linked; bitmaps rule out most pairs before their sets are compared.

    Without ``shingles`` the sides hold sets, not lines.
    """
    one, two = (shingles("line_one"), shingles("line_two")) if shingles else (F.col("set_one"), F.col("set_two"))
    size_one, size_two = (F.col("size_one"), F.col("size_two")) if shingles else (F.size("set_one"), F.size("set_two"))
    common = F.size(F.array_intersect(one, two))

    enough = least / (1 + least) * (size_one + size_two) - 1e-9
    within = (size_one - _missing("one", "two") >= enough) & (size_two - _missing("two", "one") >= enough)
    # Equal to common >= least * (size_one + size_two - common), with the intersection made once.
    return within & (common >= enough)


def _meeting(one: DataFrame, two: DataFrame, pairs: Column, least: float, shingles: Callable[[str], Column] | None = None) -> DataFrame:
    """Links (one, two) between members of one band and different components; compared where they meet, so only links leave the join."""
    apart = pairs & (F.col("component_one") != F.col("component_two"))
    met = _side(one, "one").join(_side(two, "two"), (F.col("band_one") == F.col("band_two")) & apart & _alike(least, shingles))
    return met.select(F.col("line_key_one").alias("one"), F.col("line_key_two").alias("two")).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """Rows (doc_id, text_key, line_no, class_doc_id, class_text_key, class_line_no, kept), one per line that is not blank.

    Lines count from 0 between line feeds and are trimmed of spaces; blank lines (all lines of null and
    empty texts) have no row and are always kept. The class is the first occurrence of the component, by
    doc_id (null last), hash of the text and line number; it is ``kept``, all others are not. Rows with
    equal id and text are one document, so repeated rows repeat its lines with equal results. Lines are
    known by their 64-bit hash. Lines of fewer than five characters have themselves as only shingle. An empty table gives
    no rows; other columns are not read.
    """
    found = occurrences(docs, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key", "line_no")
    grouped = found.groupBy("line_key").agg(F.first("line").alias("line"), F.min(place).alias("place"), F.count(F.lit(1)).alias("times"))
    with lifetime(docs.sparkSession), bucketed(grouped, "line_key") as lines:
        alike = linked_lines(lines.select("line_key", "line"), least)
        alike = alike.select(F.col("node").alias("line_key"), "component")
        named = stored(lines.select("line_key", "place").join(alike.hint("shuffle_hash"), "line_key"), "named")
        first = named.groupBy("component").agg(F.min("place").alias("first"))
        moved = named.join(first, "component").select("line_key", "first")
        homes = lines.select("line_key", "place", "times").join(moved.hint("shuffle_hash"), "line_key", "left")
        # Lines that occur once and have no links are their own class. The others, being written, are shuffled as the
        # occurrences are, so that a line of very many documents can be split.
        homes = homes.where("times > 1 or first is not null").select("line_key", F.coalesce("first", "place").alias("home"))
        homes = handed_on(homes, "homes")
    alone = F.col("home").isNull()

    def home(column: str) -> Column:
        return F.when(alone, F.col(column)).otherwise(F.col(f"home.{column}"))

    own = (F.col("doc_id").eqNullSafe(F.col("home.doc_id"))) & (F.col("text_key") == F.col("home.text_key")) & (F.col("line_no") == F.col("home.line_no"))
    return (
        found.select("doc_id", "text_key", "line_no", "line_key")
        .join(homes.hint("shuffle_hash"), "line_key", "left")
        .select(
            "doc_id",
            "text_key",
            "line_no",
            home("doc_id").alias("class_doc_id"),
            home("text_key").alias("class_text_key"),
            home("line_no").alias("class_line_no"),
            (alone | own).alias("kept"),
        )
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """``docs`` with its columns, each text without the lines that ``classes`` does not keep.

    Every row stays; a text may become empty. Null texts stay null. A column ``n_chars`` is brought up to date.
    """
    own_id, own_text, lost = unused_names(docs, "gone_id", "gone_text", "gone")
    gone = (
        classes(docs, id_col, text_col, least)
        .where("not kept")
        .groupBy(F.coalesce("doc_id", F.lit(LEAST)).alias(own_id), F.col("text_key").alias(own_text))
        .agg(F.collect_set("line_no").alias(lost))
    )
    keyed = docs.withColumns(
        {
            own_id: F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)),
            own_text: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
        }
    )
    numbered = F.transform(F.split(text_col, "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    stay = F.filter(numbered, lambda row: ~F.array_contains(lost, row["i"]))
    text = F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(stay, lambda row: row["line"]), "\n"))
    cleaned = keyed.join(gone, [own_id, own_text], "left").withColumn(text_col, text)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length(text_col).cast("long"))
    return cleaned.select(*docs.columns)
