"""The pipeline's stages one after the other, and registration."""

from collections import defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline

OPERATORS = [f"op{n}_" for n in range(1, 14)]


@pytest.mark.parametrize("prefix", OPERATORS)
def test_every_operator_has_one_query(prefix):
    assert sum(name.startswith(prefix) for name in entry.queries()) == 1


def test_stages_keep_the_columns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_small)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] >= counts[3] > counts[4]


def test_run_packs_what_is_left(spark, sf_small):
    rows = corpus_pipeline.run(spark, sf_small).collect()
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
    for parts in pieces.values():
        assert sum(p.length for p in parts) == parts[0].doc_tokens
