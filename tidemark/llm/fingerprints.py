"""Document fingerprints by SimHash, in DataFrame functions alone.

Terms (pairs of neighbouring words) are hashed to 64 bits and vote on every bit with their weight.
Votes are counted two bits to a number: bit i and bit i + 32 of a hash stand in the lower and the
upper half of one long, so 32 sums count all 64 bits. All fingerprints within a Hamming radius are
found by permuted block tables: with the bits in more blocks than the radius, some choice of blocks
is untouched by any difference, so each choice is a table looked up by equality.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import stored

BITS = 64
LANE = 0x0000_0001_0000_0001


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def votes(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Rows (keys..., fp): the majority of the votes of all terms of the texts of a key.

    A term is a word and the word after it, divided by spaces; the last word stands alone. A term's
    weight grows with its length from 1 to 4, and counts as often as the term occurs.
    """
    words = F.split(F.col(text_col), " ")
    spread = texts.select(*keys, words.alias("one")).select(
        *keys, F.inline(F.arrays_zip("one", F.slice("one", F.lit(2), F.size("one")).alias("two")))
    )
    length = F.octet_length("one") + F.coalesce(F.octet_length("two"), F.lit(0))
    terms = spread.select(
        *keys, F.xxhash64("one", "two").alias("h"), F.least(F.lit(4), F.lit(1) + F.floor(length / 8)).cast("long").alias("weight")
    )
    lanes = [
        F.sum(F.shiftright("h", i).bitwiseAND(F.lit(LANE)) * F.col("weight")).alias(f"lane{i}") for i in range(BITS // 2)
    ]
    counted = terms.groupBy(*keys).agg(F.sum("weight").alias("total"), *lanes)
    bits = F.lit(0).cast("long")
    for i in range(BITS // 2):
        low = F.col(f"lane{i}").bitwiseAND(F.lit(0xFFFF_FFFF)) * 2 > F.col("total")
        high = F.shiftrightunsigned(f"lane{i}", 32) * 2 > F.col("total")
        bits = bits.bitwiseOR(F.when(low, F.lit(signed(1 << i))).otherwise(F.lit(0).cast("long")))
        bits = bits.bitwiseOR(F.when(high, F.lit(signed(1 << (i + 32)))).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, bits.alias("fp"))


def near_fingerprints(prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """Pairs (one, two, distance), one < two, of all distinct values of ``fp`` within the radius, each once.

    Null fingerprints take no part; repeated ones count once. There is a table for every choice of
    ``blocks - radius`` blocks, keyed by these blocks; a pair belongs to the first table that holds it.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block_masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = [signed(sum(chosen)) for chosen in combinations(block_masks, blocks - radius)]
    tables = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("block_key")) for i, m in enumerate(masks)])
    spread = prints.where(F.col("fp").isNotNull()).select("fp").distinct().select("fp", F.inline(tables))
    left, right = spread.withColumnRenamed("fp", "one").alias("l"), spread.withColumnRenamed("fp", "two").alias("r")
    apart = F.col("one").bitwiseXOR(F.col("two"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    return left.join(
        right,
        (F.col("l.part") == F.col("r.part"))
        & (F.col("l.block_key") == F.col("r.block_key"))
        & (F.col("one") < F.col("two"))
        & (F.bit_count(apart) <= radius)
        & (first == F.col("l.part")),
    ).select("one", "two", F.bit_count(apart).cast("int").alias("distance"))


def followers(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Each key row with that of the next one in descending order, the first after the last.

    Keys are dealt by range and looked at within a range; only one row per range, as many as there
    are partitions, is compared across ranges.
    """
    down = [F.desc(key) for key in keys]
    dealt = stored(rows.repartitionByRange(parts, *down).withColumn("range", F.spark_partition_id()), "ranges")
    order = Window.partitionBy("range").orderBy(*down)
    inside = dealt.select(*rows.columns, "range", *[F.lead(key).over(order).alias(f"next_{key}") for key in keys])
    heads = dealt.groupBy("range").agg(F.max(F.struct(*keys)).alias("head"))
    # One row per range.
    ring = Window.orderBy("range")
    ends = heads.select("range", F.coalesce(F.lead("head").over(ring), F.first("head").over(ring)).alias("ahead"))
    last = F.col(f"next_{keys[-1]}").isNull()
    return inside.join(F.broadcast(ends), "range").select(
        *rows.columns, *[F.when(last, F.col(f"ahead.{key}")).otherwise(F.col(f"next_{key}")).alias(f"next_{key}") for key in keys]
    )


def likeness(one: Column | str, two: Column | str) -> Column:
    """Share of equal bits of two fingerprints."""
    one, two = (F.col(c) if isinstance(c, str) else c for c in (one, two))
    return F.lit(1.0) - F.bit_count(one.bitwiseXOR(two)) / F.lit(float(BITS))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp, near), one per row of ``docs``.

    The edited text has its last third (rounded down, in code points) replaced by the first as many
    code points of the next document in descending order of ids, the first following the last.
    ``near`` counts the other distinct fingerprints of the table within ``radius`` bits. Null texts are
    empty; an empty text has one empty term. Rows with a null id come last in the order, rows with
    equal ids follow by the hash of their text, and repeated rows take one place and have equal
    results. A single row follows itself. An empty table gives no rows. Other columns are not read.
    """
    least = -(1 << 63)
    keys = ["doc_key", "text_key"]
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.select("doc_id", F.coalesce("doc_id", F.lit(least)).alias("doc_key"), F.xxhash64("text").alias("text_key"), "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = followers(base.groupBy(*keys).agg(F.first(F.char_length("text")).cast("long").alias("n_chars")), keys, parts)
    order = stored(order, "order")
    # What the document before needs of a text: the first third of its own length.
    wanted = order.select(F.col("doc_key").alias("to_doc"), F.col("text_key").alias("to_text"), (F.col("n_chars") / 3).cast("long").alias("cut"),
                          F.col("next_doc_key").alias("doc_key"), F.col("next_text_key").alias("text_key"))
    heads = (
        base.select(*keys, "text").join(wanted, keys)
        .groupBy(F.col("to_doc").alias("doc_key"), F.col("to_text").alias("text_key"))
        .agg(F.first(F.substring("text", F.lit(1), F.col("cut").cast("int"))).alias("head"))
    )
    n_chars = F.char_length("text")
    cut = F.floor(n_chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - cut), "head")
    both = base.select(*keys, "text").join(heads, keys).select(*keys, "text", edited.alias("edited"))
    variants = both.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("variant"), F.col("text").alias("body"), F.lit(None).cast("string").alias("digest")),
                F.struct(F.lit(1).alias("variant"), F.col("edited").alias("body"), F.sha2("edited", 256).alias("digest")),
            )
        ),
    )
    counted = votes(variants, [*keys, "variant", "digest"], "body")
    pivoted = counted.groupBy(*keys).agg(
        F.max(F.when(F.col("variant") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("variant") == 1, F.col("fp"))).alias("edited_fp"),
        F.max("digest").alias("edited_sha256"),
    )
    prints = stored(pivoted, "simhash")
    pairs = near_fingerprints(prints, radius)
    near = pairs.select(F.explode(F.array("one", "two")).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("near"))
    joined = (
        order.join(prints, keys)
        .join(
            prints.select(F.col("doc_key").alias("next_doc_key"), F.col("text_key").alias("next_text_key"), F.col("fp").alias("next_fp")),
            ["next_doc_key", "next_text_key"],
        )
        .join(near, "fp", "left")
    )
    ids = base.select("doc_id", *keys)
    return ids.join(joined, keys).select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp", F.coalesce("near", F.lit(0)).alias("near")
    )
