"""Extra columns of any name, a ledger that begins, and quality scores step by step."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import lines, mixing, neardup, quality, secret_scan

# Names that the operators use or used inside.
NAMES = [
    *("gone", "GONE_ID", "gone_text", "__gone", "__gone_id", "__gone_text", "own_id", "own_text", "__id", "__text", "line", "node"),
    *("quality_score", "__quality", "mix_kept", "__mix_kept", "mix_tokens", "component", "first", "least", "band", "class", "part"),
]


@pytest.fixture(scope="module")
def docs(spark):
    words = [f"w{i}" for i in range(300)]
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(words, 30)) + "\n" + " ".join(rng.choice(words, 12)) for _ in range(12)]
    texts += [texts[0], texts[1] + " more", None, ""]
    rows = [(i, t, "en", "src0", len(t or ""), *[f"{name} {i}" for name in NAMES]) for i, t in enumerate(texts)]
    fields = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, fields + "".join(f", `{name}` string" for name in NAMES))


def untouched(docs, found):
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows and all(row[name] == f"{name} {row.doc_id}" for row in rows for name in NAMES)


@pytest.mark.parametrize("operator", [lines.without_repeats, neardup.one_per_similar_group])
def test_extra_columns_keep_their_values(docs, operator):
    untouched(docs, operator(docs))


def test_stages_keep_extra_columns(spark, docs, sf_small):
    untouched(docs, corpus_pipeline.keep_good(spark, docs, sf_small).unionByName(docs.limit(1)))
    untouched(docs, corpus_pipeline.mix(spark, docs, sf_small).unionByName(docs.limit(1)))


def test_mixing_reads_the_named_text(docs):
    renamed = docs.select("doc_id", F.col("text").alias("body"), "lang", "source")
    found = mixing.mixed(renamed, mixing.corpus_margins()[:2], 0.5, text_col="body")
    assert found.agg(F.sum("mix_tokens")).first()[0] > 0


def test_a_ledger_begins_at_a_new_path(spark, docs, tmp_path):
    path = str(tmp_path / "ledger")
    found = secret_scan.scan(docs, path)
    assert found.count() == docs.count()
    held = spark.read.schema(secret_scan.LEDGER_SCHEMA).parquet(path).count()
    # The second run finds every pair of blob and rule version in the ledger.
    assert secret_scan.scan(docs, path).count() == docs.count()
    assert spark.read.schema(secret_scan.LEDGER_SCHEMA).parquet(path).count() == held
    assert secret_scan.scan(docs.unionByName(docs.limit(1).withColumn("text", F.lit("new"))), path).count() == docs.count() + 1
    assert spark.read.schema(secret_scan.LEDGER_SCHEMA).parquet(path).count() == held + 1


def plain_score(model, text):
    """A document's score from its bytes, passage by passage."""
    data = (text or "").encode()
    codes, logits = [], []
    for begin in range(0, max(1, len(data)), quality.PASSAGE):
        part = data[begin : begin + quality.PASSAGE]
        single, pairs = [0] * 128, [0] * quality.PAIRS
        for byte in part:
            single[byte if byte < 128 else byte & 31] += 1
        for a, b in zip(part, part[1:]):
            pairs[((a * 0x9E3779B1 & 0xFFFFFFFF ^ b * 0x85EBCA6B & 0xFFFFFFFF) * 0xC2B2AE35 & 0xFFFFFFFF) >> 24] += 1
        size = max(1, len(part))
        shares = np.sqrt(np.array(single + pairs) / size)
        scaled = (shares - model.mean) / model.spread * (size / (size + quality.HALF_TRUST))
        hidden = np.tanh(scaled @ model.encode + model.encode_bias)
        gate = np.tanh(hidden @ model.tanh_gate) / (1 + np.exp(-(hidden @ model.open_gate)))
        codes.append(hidden)
        logits.append(gate @ model.attend)
    weights = np.exp(np.array(logits) - max(logits))
    bag = (np.array(codes) * weights[:, None]).sum(0) / weights.sum()
    return 1 / (1 + math.exp(-(bag @ model.weigh + model.bias[0])))


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(4)
    bags = [rng.random((int(n), quality.FEATURES)) for n in rng.integers(1, 5, 40)]
    return quality.fit(bags, np.arange(40) % 2 * 1.0, epochs=2)


def test_scores_equal_a_plain_forward_pass(model):
    texts = ["", None, "a", "Ähnlich ü", "x" * 768, "y z" * 400, "long text " * 9000]
    found = quality.text_scores(model, pa.array(texts))
    assert found == pytest.approx([plain_score(model, text) for text in texts], abs=1e-7)
    for i, text in enumerate(texts):
        assert quality.text_scores(model, pa.array([text], pa.string()))[0] == found[i]
        assert quality.text_scores(model, pa.array(["other"] * 700 + [text, "more"], pa.string()).slice(300))[400] == found[i]
    assert len(quality.text_scores(model, pa.array([], pa.string()))) == 0


def test_a_very_long_text_costs_little_more_than_itself(model):
    text = pa.array(["some words of a text " * 10_000_000])
    tracemalloc.start()
    assert 0 <= quality.text_scores(model, text)[0] <= 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.2 * 210e6
