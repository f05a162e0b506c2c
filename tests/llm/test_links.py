"""Links within bands, and the prints that pick what the pipeline compares."""

import itertools

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import lines, links, neardup


def test_large_groups_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(links, "SMALL", 2)
    monkeypatch.setattr(links, "BLOCK", 3)
    rng = np.random.default_rng(21)
    sets = {}
    for key in range(60):
        base = np.random.default_rng(key % 6).integers(0, 1 << 40, 60)
        changed = rng.random(60) < 0.07
        sets[key] = {int(x) for x in np.where(changed, rng.integers(0, 1 << 40, 60), base)}
    # One band holds all of them, another some; the first member is far from most.
    texts = spark.createDataFrame([(key, " ".join(map(str, sorted(found)))) for key, found in sets.items()], "line_key long, line string")
    prints = texts.select("line_key", F.lit(1).cast("long").alias("a"), (F.col("line_key") % 5 + 2).alias("b"))
    expected = {key: key for key in sets}

    def find(key):
        while expected[key] != key:
            key = expected[key]
        return key

    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for a, b in pairs:
        expected[max(find(a), find(b))] = min(find(a), find(b))
    linked = links.linked(texts, prints, [F.col("a"), F.col("b")], [], F.lit(True), 0.8, lambda line: F.split(line, " "), passes=2)
    found = {row.node: row.component for row in linked.collect()}
    assert found == {key: find(key) for key in {k for pair in pairs for k in pair}} and len(pairs) > 60


def test_similar_texts_meet_in_a_table():
    rng = np.random.default_rng(22)
    tables = neardup.tables_for(200_000, 0.8)
    met = []
    for _ in range(300):
        words = [f"w{x}" for x in rng.integers(0, 5_000, int(rng.integers(60, 400)))]
        other = list(words)
        while True:
            place, before = int(rng.integers(len(words))), list(other)
            other[place] = f"e{rng.integers(1_000_000)}"
            one, two = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (words, other))
            if len(one & two) < 0.8 * len(one | two):
                break
        a, b = (neardup.wide_bits(" ".join(t)) for t in (words, before))
        met.append((a != b).sum() <= neardup.WIDE_RADIUS and any((a[places] == b[places]).all() for places in tables))
    assert np.mean(met) > 0.97


def test_the_stage_links_by_simhash(spark, monkeypatch):
    words = [f"w{x}" for x in np.random.default_rng(23).integers(0, 5_000, 200)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "other"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, docs, "").collect()] == [1]
    # Without prints that agree nothing is compared.
    monkeypatch.setattr(neardup, "wide_close", lambda: F.lit(False))
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, docs, "").collect()) == [1, 2]


def test_near_copies_of_one_line_are_not_all_verified(spark, monkeypatch):
    rng = np.random.default_rng(24)
    letters = list("abcdefghijklmnopqrstuvwxyz ")
    base = "".join(rng.choice(letters, 500)) * 2
    texts = [base]
    for number in range(90):
        changed = list(base)
        for at in rng.choice(len(base), 12 if number % 3 else 24, replace=False):
            changed[at] = "#"
        texts.append("".join(changed))
    sets = [{text[i : i + 5] for i in range(len(text) - 4)} for text in texts]
    linked = {pair for pair in itertools.combinations(range(91), 2) if len(sets[pair[0]] & sets[pair[1]]) >= 0.8 * len(sets[pair[0]] | sets[pair[1]])}
    root = list(range(91))

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    asked, verified = [], links.verified

    def counting(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(links, "verified", counting)
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = {row.doc_id: row.class_doc_id for row in lines.classes(docs).collect()}
    assert all(find(found[key]) == find(key) for key in found)
    assert np.mean([found[key] == find(key) for key in found]) > 0.97
    # Far fewer than the 4,095 pairs of the group.
    assert sum(asked) < 500, asked


def test_more_lines_have_longer_bands():
    rng = np.random.default_rng(25)
    for rows in (1_000, 2_000_000, 100_000_000):
        bands = lines.bands_for(rows, 0.8)
        equal = rng.random((4_000, 1 + max(map(max, bands)))) < 0.8
        assert np.mean(np.any([equal[:, band].all(axis=1) for band in bands], axis=0)) > 0.98
    assert [len(lines.bands_for(rows, 0.8)[0]) for rows in (1_000, 2_000_000, 100_000_000)] == [4, 6, 8]


def test_unrelated_texts_are_mostly_alone_in_tables(spark):
    rng = np.random.default_rng(26)
    rows = [(key, " ".join(f"w{x}" for x in rng.integers(0, 100_000, 60))) for key in range(1_500)]
    tables = neardup.tables_for(len(rows), 0.8)
    prints = neardup.wide_prints(spark.createDataFrame(rows, "line_key long, line string"), tables)
    shared = links._shared(prints, [F.col("bands")[number] for number in range(len(tables))])
    assert shared.count() < 0.5 * len(rows) * len(tables)


def test_more_passes_do_not_repeat_the_comparisons(spark, monkeypatch):
    # A written table is a plan and jobs that the driver keeps account of; only the grouping of bands is done in passes.
    labels, stored = [], links.stored

    def counting(df, label, **options):
        labels.append(label)
        return stored(df, label, **options)

    monkeypatch.setattr(links, "stored", counting)
    texts = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e f"), (3, "x y z")], "line_key long, line string")
    prints = texts.select("line_key", *[F.lit(n).cast("long").alias(f"band{n}") for n in range(8)])
    bands = [F.col(f"band{n}") for n in range(8)]
    linked = links.linked(texts, prints, bands, [], F.lit(True), 0.8, lambda line: F.split(line, " "), passes=8)
    assert sorted(tuple(row) for row in linked.collect()) == [(1, 1), (2, 1)]
    assert labels.count("shared") == 8 and len(labels) <= 20, labels


def test_a_shingle_takes_part_in_one_part_of_the_minima(spark):
    rng = np.random.default_rng(27)
    rows, pairs = [], []
    for size in (9, 18, 70, 250):
        for _ in range(250):
            # |one & two| / |one | two| is 0.8 or just above.
            lost = int(size / 9)
            whole = rng.integers(-(1 << 63), (1 << 63) - 1, size + lost).tolist()
            one, two = len(pairs) * 2, len(pairs) * 2 + 1
            pairs.append(size)
            rows += [(one, h) for h in whole[:size]] + [(two, h) for h in whole[lost:]]
    bands = lines.bands_for(2_000_000, 0.8)
    prints = lines.signatures(spark.createDataFrame(rows, "line_key long, h long"), bands)
    # A quarter of the bands, and of the minima, for a part.
    assert len([c for c in prints.columns if c.startswith("band")]) * 4 == len(bands)
    met = prints.select((F.col("line_key") / 2).cast("long").alias("pair"), "line_key", F.explode(F.array(*prints.columns[2:])).alias("band"))
    met = met.groupBy("pair", "band").agg(F.countDistinct("line_key").alias("lines")).where("lines = 2").select("pair").distinct()
    found = {row.pair for row in met.collect()}
    for size in sorted(set(pairs)):
        assert np.mean([pair in found for pair, own in enumerate(pairs) if own == size]) > 0.96, size


def test_bitmaps_hold_parities(spark):
    rng = np.random.default_rng(28)
    texts = ["abc", "aaaaaaaaaa", *["".join(rng.choice(list("abcde "), size)) for size in (5, 40, 900)]]
    held = spark.createDataFrame([*enumerate(texts)], "line_key long, line string")
    sets = {row.line_key: row.found for row in held.select("line_key", lines.shingle_hashes("line").alias("found")).collect()}
    for row in lines.parities(held).collect():
        bits = [0] * lines.MAP_LONGS
        for h in sets[row.line_key]:
            bits[(h >> 6) % lines.MAP_LONGS] ^= 1 << (h & 63)
        assert row.n == len(sets[row.line_key])
        assert [row[name] % (1 << 64) for name in lines.MAPS] == bits
