"""The corpus operators on small awkward tables, against brute force."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import components, fingerprints, licenses, lines, mixing, neardup, packing, pivots, quality, secret_scan, separators, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, part string"


def docs_of(spark, texts):
    rows = [(i, t, "en" if i is None or i % 3 else None, f"src{(i or 0) % 4}", len(t or ""), "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, n)) for n in (60, 80, 120, 40)]
    near = [" ".join(b.split()[:-1] + ["changed"]) for b in base]
    texts = [*base, *near, base[0], base[0], None, "", "   ", "one", "two words", "\n\n", "ÄÖ ü ß x y z", " ".join(rng.choice(words, 9000))]
    rows = list(enumerate(texts)) + [(3, base[3]), (3, base[3]), (None, base[1]), (None, None), (7, "another text of the same id")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, awkward):
    return docs_of(spark, awkward)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- components ------------------------------------------------------------------------------


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(2, 1), (5, 5), (None, 3), (900, 901)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert found == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)} | {900: 900, 901: 900}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- 1 quality -------------------------------------------------------------------------------


def test_quality_learns_from_part_and_scores_all(spark, sf_small):
    documents, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(documents, labels).join(labels, "doc_id").select("score", "quality", quality.held_out("doc_id").alias("held")).collect()
    good, bad = ([r.score for r in rows if r.held and r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.9
    ids = documents.select("doc_id", quality.held_out("doc_id").alias("h")).collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.h for r in ids)


def test_quality_takes_every_row(spark, docs, empty, awkward):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (1, None, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == len(awkward) and all(0 <= r.score <= 1 for r in rows) and rows[0].label == "x"
    by_text = defaultdict(set)
    for row in rows:
        by_text[row.text or ""].add(row.score)
    assert all(len(scores) == 1 for scores in by_text.values())
    assert quality.scored(empty, labels).count() == 0
    assert {r.score for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    features, counts = rng.random((7, quality.FEATURES)), np.array([1, 4, 2])
    labels = np.array([1.0, 0.0, 1.0])
    model = quality.fit([features[:1], features[1:5], features[5:]], labels, epochs=1)

    def loss(m):
        s = quality.forward(m, features, counts)["score"]
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    grads = quality.gradient(model, counts, labels, quality.forward(model, features, counts), 0.0)
    for i in range(2, 9):
        part = np.zeros_like(model[i])
        part.flat[0] = 1e-5
        up, down = (loss(model._replace(**{model._fields[i]: model[i] + s * part})) for s in (1, -1))
        assert grads[i].flat[0] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8)


# --- 2 licenses ------------------------------------------------------------------------------


def test_license_spans_and_coverage(spark, empty):
    notice = licenses.TEMPLATES["mit"]
    changed = notice.replace("without restriction", "with no restriction at all")
    texts = ["intro words\n" + notice + " more", "x " + changed, "Licensed   under CC\nBY-NC 4.0.", "licensed under", None, "", "ü " + licenses.TEMPLATES["gpl-3.0-notice"]]
    rows = licenses.license_hits(docs_of(spark, [*enumerate(texts), (None, texts[2])])).collect()
    found = {(r.doc_id, r.template): r for r in rows}
    assert found[0, "mit"].coverage == 1 and texts[0][found[0, "mit"].start : found[0, "mit"].end] == notice[:-1]
    assert 0.9 < found[1, "mit"].coverage < 1
    assert texts[2][found[2, "cc-by-nc-4.0-notice"].start : found[2, "cc-by-nc-4.0-notice"].end] == texts[2][:-1]
    assert found[6, "gpl-3.0-notice"].start == 2 and (None, "cc-by-nc-4.0-notice") in found
    assert {r.doc_id for r in rows} == {0, 1, 2, 6, None}
    assert licenses.license_hits(empty).count() == 0


def test_license_places_are_all_found(spark):
    line = licenses.TEMPLATES["mit-notice"]
    text = "\n".join(["a b c", line, "d e f " * 30, line, line])
    rows = licenses.license_hits(docs_of(spark, [(1, text)])).where("template = 'mit-notice'").collect()
    assert sorted(r.start for r in rows) == [m.start() for m in re.finditer(re.escape(line), text)]


# --- 3 secrets -------------------------------------------------------------------------------


def test_secret_spans(spark, empty):
    texts = ["password: token: abcdefgh", "API_KEY='abc' secret = \"xyz123\"", "AKIA" + "A" * 16 + " AKIAB", "f" * 23 + " " + "a" * 24, "ſecret=abcdefgh", None, "", "éé token=abcdef,token=abcdefg"]
    rows = {r.doc_id: r.findings for r in secret_scan.scan(docs_of(spark, list(enumerate(texts)))).collect()}
    rules = [(r.name, re.compile(r.pattern, re.ASCII), r.group, r.least) for r in secret_scan.RULES]
    for i, text in enumerate(texts):
        want = sorted((m.start(), k, n, m.end()) for k, (n, p, g, least) in enumerate(rules) for m in p.finditer(text or "") if len(m.group(g)) >= least)
        assert [tuple(f) for f in rows[i]] == want
    assert secret_scan.scan(empty).count() == 0


def test_secret_ledger_scans_a_pair_once(spark, docs, awkward, tmp_path):
    path = str(tmp_path / "ledger")
    secret_scan.scan(docs, None)
    old = secret_scan.RULES[:2]
    secret_scan.scan_unseen(docs, secret_scan.empty_ledger(spark), rules=old).write.parquet(path)
    known = spark.read.schema(secret_scan.LEDGER_SCHEMA).parquet(path)
    assert secret_scan.scan_unseen(docs, known, rules=old).count() == 0
    more = secret_scan.scan_unseen(docs, known).collect()
    assert {tuple(x.rule for x in r.results) for r in more} == {("hex",)} and len(more) == len({t or "" for _, t in awkward})
    newer = (secret_scan.RULES[0]._replace(version=2),)
    assert secret_scan.scan_unseen(docs, known, rules=newer).count() == len(more)
    assert secret_scan.scan(docs, path).count() == len(awkward)
    assert spark.read.parquet(path).count() == 2 * len(more)


# --- 4 fingerprints --------------------------------------------------------------------------


def test_edited_texts_and_neighbours(spark, docs, awkward, empty):
    rows = fingerprints.document_fingerprints(docs).collect()
    assert len(rows) == len(awkward)
    key = lambda i, t: (i if i is not None else -(1 << 63), signed_hash(t or ""))
    order = sorted({key(i, t) for i, t in awkward}, reverse=True)
    text_of = {key(i, t): t or "" for i, t in awkward}
    edited = {}
    for n, k in enumerate(order):
        own, ahead = text_of[k], text_of[order[(n + 1) % len(order)]]
        cut = len(own) // 3
        edited[k] = hashlib.sha256((own[: len(own) - cut] + ahead[:cut]).encode()).hexdigest()
    assert sorted(r.edited_sha256 for r in rows) == sorted(edited[key(i, t)] for i, t in awkward)
    by_print = defaultdict(set)
    for r in rows:
        by_print[r.doc_id].add(r.fp)
    assert by_print[0] == by_print[8] == by_print[9] and by_print[10] == by_print[11]
    assert fingerprints.document_fingerprints(empty).count() == 0


def signed_hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def plain_votes(text):
    """Every word with the one after it votes on each bit, with a weight that grows with their length."""
    words, total, ups = text.split(" "), 0, [0] * 64
    for i, one in enumerate(words):
        two = words[i + 1] if i + 1 < len(words) else None
        h = xxhash.xxh64_intdigest(one.encode(), 42)
        if two is not None:
            h = xxhash.xxh64_intdigest(two.encode(), h)
        weight = min(4, 1 + (len(one.encode()) + len((two or "").encode())) // 8)
        total += weight
        ups = [up + weight * (h >> bit & 1) for bit, up in enumerate(ups)]
    return sum(1 << bit for bit, up in enumerate(ups) if 2 * up > total)


def test_votes_equal_a_plain_count(spark, awkward):
    texts = sorted({t or "" for _, t in awkward} | {" a  b ", "x" * 50, "ü ü ü"})
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")
    found = {r.k: r.fp & (1 << 64) - 1 for r in fingerprints.votes(frame, ["k"], "text").collect()}
    assert found == {i: plain_votes(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("search", [fingerprints.near_fingerprints, lambda d: neardup.close_pairs(d, 4)])
def test_close_fingerprints_are_all_found(spark, search):
    radius = 3 if search is fingerprints.near_fingerprints else 4
    rng = np.random.default_rng(1)
    seeds = rng.integers(-(1 << 63), (1 << 63) - 1, 60)
    values = {0, -1, 1}
    for seed in seeds:
        for flips in range(0, 7):
            bits = rng.choice(64, flips, replace=False)
            values.add(int(np.int64(seed) ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64), initial=np.uint64(0)).view(np.int64)))
    values = sorted(values)
    want = {(a, b, (a ^ b & (1 << 64) - 1).bit_count()) for a, b in itertools.combinations(values, 2) if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius}
    found = search(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    assert {(r.one, r.two) for r in found} == {(a, b) for a, b, _ in want} and len(found) == len(want)


# --- 5 lines ---------------------------------------------------------------------------------


def test_line_classes_and_cleaned_texts(spark, empty):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    common = " ".join(rng.choice(words, 40))
    fuzzy = common.rsplit(" ", 1)[0] + " other"
    own = [" ".join(rng.choice(words, 30)) for _ in range(6)]
    texts = [f"{own[0]}\n{common}", f" {common} \n\n{own[1]}", fuzzy, None, "", f"{own[2]}\n{own[2]}\n{own[3]}", own[4]]
    rows = [*enumerate(texts), (6, own[4]), (None, own[0])]
    docs = docs_of(spark, rows)
    found = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.kept) for r in lines.classes(docs).collect()}
    assert found[0, 1] == (0, 1, True) and found[1, 0] == (0, 1, False) and found[2, 0] == (0, 1, False)
    assert found[5, 1] == (5, 0, False) and found[6, 0] == (6, 0, True) and found[None, 0] == (0, 0, False)
    cleaned = sorted(lines.without_repeats(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [r.text for r in cleaned] == [texts[0], f"\n{own[1]}", "", None, "", f"{own[2]}\n{own[3]}", own[4], own[4], ""]
    assert all(r.n_chars == len(r.text) for r in cleaned if r.text is not None) and cleaned[0].label == "x"
    assert lines.classes(empty).count() == 0 and lines.without_repeats(empty).count() == 0


def test_bitmaps_lose_no_link(spark):
    rng = np.random.default_rng(11)
    sets = {}
    for key in range(90):
        base = np.random.default_rng(key % 3).integers(-(1 << 62), 1 << 62, (5, 60, 900)[key % 3])
        changed = rng.random(len(base)) < 0.12
        sets[key] = {int(x) for x in np.where(changed, rng.integers(-(1 << 62), 1 << 62, len(base)), base)}
    rows = [(1, key, key, sorted(found)) for key, found in sets.items()]
    members = spark.createDataFrame(rows, "band long, line_key long, component long, set array<long>")
    held = members.select("*", *lines.bitmap("set"))
    met = lines._meeting(held, held, F.col("line_key_one") < F.col("line_key_two"), 0.8)
    expected = {
        (a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    }
    assert expected and {tuple(row) for row in met.collect()} == expected


def test_similar_lines_by_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"v{i}" for i in range(500)]
    texts = []
    for _ in range(40):
        base = list(rng.choice(words, 40))
        for edits in range(4):
            changed = list(base)
            for at in rng.choice(40, edits, replace=False):
                changed[at] = f"e{rng.integers(1_000_000)}"
            texts.append(" ".join(changed))
    shingles = [set(zip(t.split(), [*t.split()[1:], None])) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    found = {r.doc_id: r.class_doc_id for r in lines.classes(docs_of(spark, list(enumerate(texts)))).collect()}
    assert np.mean([found[i] == find(i) for i in found]) > 0.97
    assert all(find(found[i]) == find(i) for i in found)


def test_short_lines_with_typos_by_brute_force(spark):
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyzäß語")
    texts = ["語" * 3, "語" * 4]
    for words, length in [(n, m) for n, m in ((1, 70), (3, 20), (6, 9), (8, 7), (12, 5)) for _ in range(12)]:
        base = " ".join("".join(rng.choice(letters, length)) for _ in range(words))
        texts.append(base)
        for _ in range(2):
            at = int(rng.choice([i for i, c in enumerate(base) if c != " "]))
            texts.append(base[:at] + "#" + base[at + 1 :])
    shingles = [{t[i : i + 5] for i in range(max(1, len(t) - 4))} for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    found = {r.doc_id: r.class_doc_id for r in lines.classes(docs_of(spark, list(enumerate(texts)))).collect()}
    assert sum(find(i) != i for i in found) > 90
    assert np.mean([found[i] == find(i) for i in found]) > 0.97
    assert all(find(found[i]) == find(i) for i in found)


# --- 6 separators ----------------------------------------------------------------------------


def test_separators_across_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(separators, "GROUP", 3)
    rng = np.random.default_rng(6)
    want = []
    for file, sizes in enumerate([[5, 0, 0, 40, 3], [], [100], rng.integers(0, 30, 50).tolist()]):
        stream = [t for size in sizes for t in [*rng.integers(0, 9, size), 99]] + [1, 2]
        (tmp_path / f"f{file}.bin").write_bytes(np.array(stream, "<u2").tobytes())
        want += [(f"f{file}.bin", n, size) for n, size in enumerate(sizes)]
    (tmp_path / "none.bin").write_bytes(b"")
    blocks = separators.read_flat(spark, str(tmp_path), block_tokens=7)
    found = separators.token_counts(blocks, 99).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.document, r.tokens) for r in found) == want


def test_token_counts_of_documents(spark, docs, awkward, empty):
    encoder = tokens.WordEncoder("word_bpe_49k.json", special_as_text=True)
    extra = [*awkward, (50, "a <|endoftext|> b")]
    want = sorted((-1 if i is None else i, len(encoder.encode([t or ""])[0])) for i, t in extra)
    found = separators.document_token_counts(docs_of(spark, extra)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.tokens) for r in found) == want
    assert separators.document_token_counts(empty).count() == 0


def test_word_encoder_equals_the_tokenizer():
    encoder = tokens.WordEncoder("word_bpe_49k.json")
    for text in ["It's (a) test, don't! ###x### <|endoftext|>. y", "\x1c a\x1cb \x85", "Café́　a\xa0b​c", "Straße ÀB ſ K", "12,3. 4% x_y", ""]:
        assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# --- 7 packing -------------------------------------------------------------------------------


def test_packs_hold_every_id_once(spark, docs, awkward, empty):
    rows = packing.pack(docs, with_ids=True).collect()
    encoder = tokens.WordEncoder("word_bpe_49k.json")
    want = sorted([*encoder.encode([t or ""])[0].tolist(), 1] for _, t in awkward)
    sequences, ids = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) <= 2048 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        ids[r.doc_id, r.doc_tokens].append((r.start, r.ids))
    for parts in sequences.values():
        ends = list(itertools.accumulate(length for _, length in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    # Rows with equal ids and lengths have one piece each; a long text has its pieces in order.
    whole = []
    for parts in ids.values():
        ordered = sorted(parts)
        whole += [found for _, found in ordered] if ordered[-1][0] == 0 else [[i for _, found in ordered for i in found]]
    assert sorted(whole) == want and max(map(len, whole)) > 2048
    assert packing.pack(empty).count() == 0


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(7)
    for _ in range(30):
        histogram = {int(k): int(v) for k, v in zip(rng.integers(1, 65, 20), rng.integers(1, 50, 20))}
        held = defaultdict(int)
        for pattern in packing.patterns(histogram, 64):
            assert 0 < sum(pattern.lengths) <= 64
            for length in pattern.lengths:
                held[length] += pattern.count
        assert held == histogram
    assert packing.patterns({}, 64) == []


# --- 8 mixing --------------------------------------------------------------------------------


def test_raking_meets_the_margins(spark):
    cells = np.array(list(itertools.product(range(3), range(2))))
    tokens_of = np.array([500.0, 300, 200, 800, 400, 600])
    shares = [np.array([0.4, 0.3, 0.3]), np.array([0.5, 0.5])]
    kept = mixing.raked(cells, tokens_of, shares, 1400, 200)
    assert all(np.allclose(np.bincount(cells[:, m], weights=kept), s * 1400) for m, s in enumerate(shares)) and (kept <= tokens_of + 1e-9).all()
    assert mixing.raked(cells[:0], tokens_of[:0], shares, 0).size == 0


def test_mixing_takes_every_row(docs, awkward, empty):
    rows = mixing.mixed(docs, mixing.corpus_margins(), 0.7).collect()
    assert len(rows) == len(awkward) and all(0 <= r.mix_probability <= 1 for r in rows) and rows[0].label == "x"
    assert {r.mix_lang for r in rows} == {"en", mixing.REST}
    assert mixing.mixed(empty, mixing.corpus_margins(), 0.7).count() == 0


def test_mixing_keeps_unnamed_and_unknown_classes(spark):
    sources = ["src0", "src1", "new", None, "new", "src2"]
    rows = [(i, "a b c d e", "en" if i % 4 else (None, "pt")[i % 8 // 4], sources[i % 6], 9, "x", "y") for i in range(6000)]
    table = spark.createDataFrame(rows, DOCS)
    margins = mixing.corpus_margins()[:2]
    kept = mixing.mixed(table, margins, 0.4).where("mix_kept").collect()
    assert sum(r.source not in mixing.SOURCES for r in kept) / len(kept) == pytest.approx(0.5, abs=0.04)
    assert sum(r.lang != "en" for r in kept) / len(kept) == pytest.approx(0.25, abs=0.04)
    assert {r.source for r in kept} == set(sources) and {r.lang for r in kept} == {"en", "pt", None}
    only = mixing.mixed(table.where("source is null or source = 'new'"), margins, 0.4).where("mix_kept").count()
    assert only / 3000 == pytest.approx(0.4, abs=0.04)
    # A class that is given no tokens on purpose stays out.
    assert mixing.raked(np.array([[0], [1]]), np.array([5.0, 5.0]), [np.array([1.0, 0.0])], 4).tolist() == [4, 0]
    assert mixing.raked(np.array([[1]]), np.array([5.0]), [np.array([1.0, 0.0])], 4).tolist() == [4]


# --- 9 near duplicates -----------------------------------------------------------------------


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_by_brute_force(docs, awkward, empty):
    prints = [plain_print(t) for _, t in awkward]
    parent = list(range(len(awkward)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(awkward)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            parent[find(j)] = find(i)
    least = defaultdict(list)
    for n, (i, _) in enumerate(awkward):
        least[find(n)] += [] if i is None else [i]
    want = [(i, f"{prints[n]:016x}", min(least[find(n)], default=None)) for n, (i, _) in enumerate(awkward)]
    found = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.one_per_group(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for _, _, c in want if c is not None})
    assert neardup.one_per_group(empty).count() == 0 and kept[0].label == "x"


def test_similar_documents_by_brute_force(spark):
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n ", "One two", "one  TWO", "ÄB c d e f"]
    for n in range(12):
        base = list(rng.choice(words, 100 + 10 * n))
        for edits in range(5):
            changed = list(base)
            for at in rng.choice(len(base), edits, replace=False):
                changed[at] = f"E{rng.integers(1_000_000)}"
            texts.append("\n ".join(changed))
    split = [re.findall(r"[^\x20\x09-\x0d]+", (t or "").lower()) for t in texts]
    shingles = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in split]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    far = 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
            far += (plain_print(texts[i]) ^ plain_print(texts[j])).bit_count() > 4
            parent[max(find(i), find(j))] = min(find(i), find(j))
    assert far > 10
    rows = [*enumerate(texts), (None, texts[10]), (10, texts[10])]
    kept = neardup.one_per_similar_group(docs_of(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({find(i) for i in range(len(texts))}) and kept[0].label == "x"
    assert neardup.one_per_similar_group(docs_of(spark, rows[:1]).limit(0)).count() == 0


# --- 10 exact search -------------------------------------------------------------------------


def test_largest_products_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pivots, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(8)
    vectors = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(150)]
    vectors += [(200 + i, vectors[i][1]) for i in range(20)] + [vectors[5], (300, [1.0] * 3), (301, [2.0] * 3)]
    vectors += [(400, None), (401, []), (402, [None] * 8), (403, [float("nan")] * 8), (404, [float("inf")] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<float>, norm int, q int")
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in pivots.largest_products(table, F.col("vec_id") % 50 == 0).collect()}
    whole = {i: np.floor(256 * np.array(v, dtype=float)).astype(int) for i, v in vectors[:173]}
    want = {}
    for q in (q for q in whole if q % 50 == 0):
        scores = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])))
        want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(scores[:5])}
    assert found == want
    assert pivots.largest_products(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
