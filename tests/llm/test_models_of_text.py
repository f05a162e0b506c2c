"""Clusters, resampling and language-model scores on small awkward tables, against plain recomputation."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import clusters, language_model, resampling

DOCS = "doc_id long, text string, row int, score long, range string, block int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", 3) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(3)
    words = [f"W{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(15, 90, 60)]
    texts += [texts[0]] * 9 + [None, "", "  \n", "one", "Ä ö\tß x\x0by\x0cz", "a.b-c 1,2", "nul\x00l", " ".join(rng.choice(words, 9000))]
    return [*enumerate(texts), (3, texts[3]), (3, texts[3]), (3, texts[4]), (None, texts[1]), (None, None)]


# --- 11 clusters -----------------------------------------------------------------------------


def plain_lloyd(vectors, dimensions, k, rounds, seed):
    kept = []
    for i, v in vectors:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in first[:k]]

    def assign():
        found = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            found.append((min(range(len(centroids)), key=distances.__getitem__), min(distances)))
        return found

    for _ in range(rounds):
        labels = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (label, _) in zip(kept, labels) if label == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, assign())], centroids


VECTORS = "vec_id long, embedding array<double>, chunk int, cluster string, distance int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS)


@pytest.mark.parametrize("scale", [1.0, 1e5, 3e9, 1e30])
def test_clusters_equal_plain_rounds(spark, scale):
    rng = np.random.default_rng(1)
    rows = [(i, (scale * rng.normal(0, 0.4, 6)).tolist()) for i in range(120)]
    rows += [(200 + i, rows[5][1]) for i in range(30)] + [rows[7], (7, rows[8][1]), (None, rows[9][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [None] * 6), (304, [float("nan")] * 6), (305, [float("inf")] * 6), (306, [1e308] * 6)]
    want, centroids = plain_lloyd(rows[:-1], 6, 12, 3, 2)
    table = vectors_of(spark, rows)
    found, final = clusters.lloyd(table, dimensions=6, clusters=12, rounds=3, shard=4, chunk=17)
    fit = [(i, c, d if d < 1 << 63 else None) for i, c, d in want]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(fit, key=str)
    assert [[int(x) for x in c] for c in final] == centroids
    total = sum(d for *_, d in want)
    for r in clusters.with_inertia(found, final).collect():
        own = sum(d for _, c, d in want if c == r.cluster)
        sized = [None if n >= 1 << 63 else n for n in (own, total)]
        if all(d is not None for *_, d in fit):
            assert [r.cluster_inertia, r.inertia] == sized
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_clusters_of_few_and_no_vectors(spark):
    table = vectors_of(spark, [(1, [0.5] * 6), (2, [0.5] * 6), (3, [2.0] * 6)])
    found, final = clusters.lloyd(table, dimensions=6, clusters=40)
    assert len(final) == 3 and {(r.id, r.distance) for r in found.collect()} == {(1, 0), (2, 0), (3, 0)}
    found, final = clusters.lloyd(table.limit(0), dimensions=6)
    assert found.count() == 0 and clusters.with_inertia(found, final).count() == 0


# --- 12 resampling ---------------------------------------------------------------------------


def plain_resampling(rows, target, buckets, longest, least, percent, seed):
    def runs(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)
        found = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % buckets for f in found]

    corpus, aim = (Counter(b for t in texts for b in runs(t)[1]) for texts in ([t for _, t in rows], target))
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    scored = []
    for i, text in rows:
        n, found = runs(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2])
    able = sorted((r for r in scored if r[1] >= least), key=order)
    drawn = percent * len(able) // 100
    ranked = [(*r, n if n <= drawn else None) for n, r in enumerate(able, 1)]
    return ranked + [(*r, None) for r in scored if r[1] < least]


@pytest.mark.parametrize("longest, percent", [(1, 10), (1, 50), (3, 37), (2, 100), (1, 0)])
def test_resampling_equals_a_plain_draw(spark, awkward, monkeypatch, longest, percent):
    monkeypatch.setattr(resampling, "PIECE", 50)
    monkeypatch.setattr(resampling, "SECTIONS", 3)
    target = ["w1 w2 W3 w1", None, "ä ö w7 w8 w9"]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resampled(docs_of(spark, awkward), aim, buckets=97, longest=longest, least_words=20, percent=percent)
    want = plain_resampling(awkward, target, 97, longest, 20, percent, resampling.SEED)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_resampling_of_nothing(spark, awkward):
    docs = docs_of(spark, awkward)
    none = docs.limit(0).select("text")
    assert resampling.resampled(docs.limit(0), none).count() == 0
    assert resampling.resampled(docs, none).count() == len(awkward)


@pytest.mark.parametrize("wanted", [1, 2, 30, 59, 60, 61, 99, 100])
def test_cutoff_takes_an_exact_number(spark, wanted):
    rows = [(5, i) for i in range(60)] + [(-(1 << 62), 100 + i) for i in range(39)] + [((1 << 63) - 1, 200)]
    table = spark.createDataFrame(rows, "a long, b long")
    found = table.where(resampling.highest(table, ["a", "b"], wanted)).collect()
    assert sorted(map(tuple, found)) == sorted(sorted(rows, reverse=True)[:wanted])


# --- 13 language model -----------------------------------------------------------------------


def plain_scores(rows, order, prior):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    texts = [(i, ["<s>", *re.findall("[^\\x20\\x09-\\x0D]+", lower(t)), "</s>"]) for i, t in rows]
    counts, after = Counter(), Counter()
    for i, line in texts:
        if not held(i):
            for j in range(1, len(line)):
                for n in range(min(order, j + 1)):
                    counts[tuple(line[j - n : j + 1])] += 1
                    after[tuple(line[j - n : j])] += 1
    known = {run: c for run, c in counts.items() if len(run) == 1}
    total = sum(known.values())

    def chance(context, word):
        if not context:
            return (counts[word,] + 0.1) / (total + 0.1 * (len(known) + 1))
        m = prior[min(len(context), len(prior)) - 1]
        return (counts[(*context, word)] + m * chance(context[1:], word)) / (after[context] + m)

    found = []
    for i, line in texts:
        places = range(1, len(line))
        base = sum(math.log10(chance((), line[j])) for j in places)
        full = sum(math.log10(chance(tuple(line[max(0, j - order + 1) : j]), line[j])) for j in places)
        found.append((i, held(i), len(places), sum((line[j],) in known for j in places), total, base, full))
    return found, chance, known


def name():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


@pytest.mark.parametrize("order, piece, block, meeting", [(3, 4096, 2_000_000, 4_000_000), (3, 7, 40, 300), (2, 5, 100, 900), (4, 6, 64, 500), (1, 8, 50, 100)])
def test_scores_equal_a_plain_model(spark, awkward, monkeypatch, order, piece, block, meeting):
    for limit, value in (("PIECE", piece), ("BLOCK", block), ("MEETING", meeting), ("WINDOW", 64)):
        monkeypatch.setattr(language_model, limit, value)
    rows = [r for r in awkward if piece == 4096 or len(r[1] or "") < 3000]
    want, chance, known = plain_scores(rows, order, language_model.PRIOR)
    found = language_model.scored(docs_of(spark, rows).repartition(3), name(), order=order).collect()
    key = lambda r: (str(r[0]), *r[1:4], round(r[5], 6), round(r[6], 6))
    assert len(found) == len(want)
    for ours, plain in zip(sorted(map(tuple, found), key=key), sorted(want, key=key)):
        assert ours[:5] == plain[:5] and ours[5:] == pytest.approx(plain[5:], abs=1e-8)
    for context in [(), ("<s>",), ("w1",), ("w1", "w2")]:
        assert sum(chance(context[-(order - 1) :] if order > 1 else (), w) for (w,) in [*known, ("unseen",)]) == pytest.approx(1)


def test_scores_of_nothing_learned(spark, awkward):
    docs = docs_of(spark, awkward)
    rows = language_model.scored(docs, F.lit(True)).collect()
    assert len(rows) == len(awkward) and all(r.train_tokens == r.n_known == 0 and r.score == 0 and r.held_out for r in rows)
    assert language_model.scored(docs.limit(0), name()).count() == 0


def test_unseen_texts_are_likelier_than_under_single_tokens(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = language_model.scored(docs, name()).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_a_text_given_twice_scores_alike(spark, awkward):
    by_text = defaultdict(set)
    docs = docs_of(spark, awkward)
    texts = {i: t for i, t in awkward if i is not None}
    for r in language_model.scored(docs, name()).where("id not in (3)").collect():
        by_text[texts.get(r.id)].add(round(r.score, 9))
    assert len(by_text[texts[0]]) == 1
