"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages. Every passage is encoded (shares of bytes and of hashed byte pairs,
through a learned layer), gated attention gives each passage a weight, and a linear layer scores the
weighted sum. Only documents carry labels: the attention learns from them which passages matter.

The model is fitted on a bounded sample of labelled documents; every document is scored whole, in
Arrow batches, from the string buffers themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Bytes in a passage.
PASSAGE = 768
PAIRS = 256
FEATURES = 128 + PAIRS + 1
# A passage of so many bytes counts half as far from the mean as a long one.
HALF_TRUST = 96
HIDDEN = 24
GATES = 16
EPOCHS = 24
# At most this many labelled documents are fitted on, the lowest by a hash of their id.
FIT_DOCUMENTS = 6_000
# Of a labelled document with more passages than this, as many evenly spread ones are fitted on.
FIT_PASSAGES = 64
# Passages encoded at one time.
ROWS = 512


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    encode: np.ndarray
    encode_bias: np.ndarray
    tanh_gate: np.ndarray
    open_gate: np.ndarray
    attend: np.ndarray
    weigh: np.ndarray
    bias: np.ndarray


def passages(sizes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each passage of the texts starts, its length, and the passages per text (one at least)."""
    counts = np.maximum(1, -(-sizes // PASSAGE))
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(begins, counts) + number * PASSAGE
    return starts, np.minimum(PASSAGE, np.repeat(begins + sizes, counts) - starts), counts


def passage_features(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Features of a few passages of a byte buffer.

    They are square roots of shares: of byte classes (bytes past 127 fold onto the lower ones' range
    from 0 to 31), and of hashed pairs of neighbouring bytes of the passage. The last one is how far
    the shares are trusted: those of a few bytes say little.
    """
    rows = len(starts)
    at = np.repeat(np.arange(rows, dtype=np.int32), lengths)
    place = np.arange(len(at)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    buffer = data[place]
    classes = np.where(buffer < 128, buffer, buffer & 31)
    single = np.bincount(at * np.int32(128) + classes, minlength=rows * 128).reshape(rows, 128)
    wide = buffer.astype(np.uint32)
    mixed = ((wide[:-1] * np.uint32(0x9E3779B1)) ^ (wide[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    hashed = (mixed >> np.uint32(24)).astype(np.int32)
    inner = at[:-1] == at[1:]
    pairs = np.bincount((at[:-1] * np.int32(PAIRS) + hashed)[inner], minlength=rows * PAIRS).reshape(rows, PAIRS)
    length = np.maximum(1, lengths)[:, None]
    return np.hstack([np.sqrt(single / length), np.sqrt(pairs / length), length / (length + HALF_TRUST)])


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of an Arrow array of texts, and where each text begins and how long it is; null is empty."""
    filled = (array.fill_null("") if array.null_count else array).cast(pa.large_string())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    return np.frombuffer(filled.buffers()[2] or b"", np.uint8), offsets[:-1], np.diff(offsets)


def coded(model: Model, features: np.ndarray) -> dict[str, np.ndarray]:
    """Code and attention of each passage."""
    scaled = (features[:, :-1] - model.mean) / model.spread * features[:, -1:]
    hidden = np.tanh(scaled @ model.encode + model.encode_bias)
    tanh_gate = np.tanh(hidden @ model.tanh_gate)
    open_gate = 1 / (1 + np.exp(-(hidden @ model.open_gate)))
    logits = (tanh_gate * open_gate) @ model.attend
    return {"scaled": scaled, "hidden": hidden, "tanh_gate": tanh_gate, "open_gate": open_gate, "logits": logits}


def attended(model: Model, hidden: np.ndarray, logits: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Score of each bag of passages; a sum over a bag does not depend on the bags beside it."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    peak = np.maximum.reduceat(logits, starts)
    raised = np.exp(logits - np.repeat(peak, counts))
    weights = raised / np.repeat(np.add.reduceat(raised, starts), counts)
    bags = np.add.reduceat(hidden * weights[:, None], starts)
    score = 1 / (1 + np.exp(-np.clip((bags * model.weigh).sum(1) + model.bias[0], -30, 30)))
    return {"weights": weights, "bags": bags, "score": score, "starts": starts}


def forward(model: Model, features: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Score of each bag, with what the gradient needs."""
    found = coded(model, features)
    return found | attended(model, found["hidden"], found.pop("logits"), counts)


def text_scores(model: Model, array: pa.Array) -> np.ndarray:
    """Score of every whole text of an Arrow array.

    Passages are encoded ROWS at a time, the last ones filled up with empty ones: products of one
    shape round alike, so a text scores the same in any batch. A text of any length costs the bytes
    of ROWS passages and one short code for each of its own.
    """
    data, begins, sizes = text_bytes(array)
    starts, lengths, counts = passages(sizes, begins)
    hidden, logits = np.empty((len(starts), HIDDEN)), np.empty(len(starts))
    for begin in range(0, len(starts), ROWS):
        rows = min(ROWS, len(starts) - begin)
        filler = np.zeros(ROWS - rows, np.int64)
        group = slice(begin, begin + rows)
        features = passage_features(data, np.append(starts[group], filler), np.append(lengths[group], filler))
        found = coded(model, features)
        hidden[group], logits[group] = found["hidden"][:rows], found["logits"][:rows]
    if not len(counts):
        return np.zeros(0)
    # The last bits of a product may still depend on the row's place among ROWS.
    return attended(model, np.round(hidden, 9), np.round(logits, 9), counts)["score"]


def gradient(model: Model, counts: np.ndarray, labels: np.ndarray, out: dict[str, np.ndarray], decay: float) -> Model:
    """Gradient of the mean log loss and the weight decay."""
    hidden, weights = out["hidden"], out["weights"]
    slope = (out["score"] - labels) / len(labels)
    to_bag = slope[:, None] * model.weigh
    spread_bag = np.repeat(to_bag, counts, axis=0)
    pull = (hidden * spread_bag).sum(1)
    mean_pull = np.add.reduceat(pull * weights, out["starts"])
    to_logit = weights * (pull - np.repeat(mean_pull, counts))
    gated = to_logit[:, None] * model.attend
    to_tanh = gated * out["open_gate"] * (1 - out["tanh_gate"] ** 2)
    to_open = gated * out["tanh_gate"] * out["open_gate"] * (1 - out["open_gate"])
    to_hidden = spread_bag * weights[:, None] + to_tanh @ model.tanh_gate.T + to_open @ model.open_gate.T
    to_encode = to_hidden * (1 - hidden**2)
    zero = np.zeros(1)
    return Model(
        zero,
        zero,
        out["scaled"].T @ to_encode + decay * model.encode,
        to_encode.sum(0),
        hidden.T @ to_tanh + decay * model.tanh_gate,
        hidden.T @ to_open + decay * model.open_gate,
        (out["tanh_gate"] * out["open_gate"]).T @ to_logit + decay * model.attend,
        out["bags"].T @ slope + decay * model.weigh,
        np.array([slope.sum()]),
    )


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """Adam over small batches of bags. Without bags, or with one class only, the score is its share of label 1."""
    rng = np.random.default_rng(seed)
    passages_in = max(1, sum(map(len, bags)))
    mean = sum((bag[:, :-1].sum(0, dtype=np.float64) for bag in bags), np.zeros(FEATURES - 1)) / passages_in
    squares = sum((((bag[:, :-1] - mean) ** 2).sum(0) for bag in bags), np.zeros(FEATURES - 1))
    model = Model(
        mean,
        np.sqrt(squares / passages_in) + 0.02,
        rng.normal(0, FEATURES**-0.5, (FEATURES - 1, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)),
        rng.normal(0, GATES**-0.5, GATES),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    )
    if len(set(labels.tolist())) < 2:
        share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
        return model._replace(weigh=np.zeros(HIDDEN), bias=np.array([np.log(share / (1 - share))]))
    first = [np.zeros_like(part) for part in model]
    second = [np.zeros_like(part) for part in model]
    steps, batch = 0, 64
    epochs = max(epochs, -(-1_200 * batch // len(bags) // 4))
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), batch):
            chosen = order[begin : begin + batch]
            counts = np.array([len(bags[i]) for i in chosen])
            features = np.vstack([bags[i] for i in chosen]).astype(np.float64)
            grads = gradient(model, counts, labels[chosen], forward(model, features, counts), 1e-4)
            steps += 1
            parts = []
            for i, (part, grad) in enumerate(zip(model, grads)):
                if i < 2:
                    parts.append(part)
                    continue
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                step = first[i] / (1 - 0.9**steps) / (np.sqrt(second[i] / (1 - 0.999**steps)) + 1e-8)
                parts.append(part - rate * step)
            model = Model(*parts)
    return model


def encoded_bags(rows: DataFrame) -> DataFrame:
    """Rows (label, features) of (label, text), for the fit; features as packed half floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, begins, sizes = text_bytes(batch.column(1))
            packed = []
            for begin, size in zip(begins, sizes):
                starts, lengths, counts = passages(np.array([size]), np.array([begin]))
                spread = np.unique(np.linspace(0, counts[0] - 1, min(counts[0], FIT_PASSAGES)).round().astype(int))
                packed.append(passage_features(data, starts[spread], lengths[spread]).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["label", "features"])

    return rows.mapInArrow(run, "label int, features binary")


def held_out(id_col: Column | str) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4; a null id is as empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learned(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    fit_documents: int = FIT_DOCUMENTS,
) -> Model:
    """Fit on at most ``fit_documents`` labelled documents that are not held out.

    Labels other than 0 and 1, null ids and ids with two different labels are not learned from. Of an
    id with several texts one is, the one with the smallest hash. The driver receives at most
    ``fit_documents`` bags of FIT_PASSAGES passages in half floats: 300 MB, with usual texts 20 MB.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).cast("long").alias("known_id"))
        .agg(F.min(label_col).cast("int").alias("known_label"), F.max(label_col).cast("int").alias("other"))
        .where("known_label = other")
        .orderBy(F.xxhash64("known_id"), "known_id")
        .limit(fit_documents)
        .select("known_id", "known_label")
    )
    texts = docs.select(F.col(id_col).cast("long").alias("known_id"), F.col(text_col).cast("string").alias("known_text"))
    # One text per id before anything is collected; each task sends one for an id at most.
    single = (
        texts.join(F.broadcast(known), "known_id")
        .groupBy("known_id", "known_label")
        .agg(F.min_by("known_text", F.struct(F.xxhash64("known_text"), "known_text")).alias("known_text"))
    )
    rows: list[Row] = encoded_bags(single.select("known_label", "known_text")).collect()
    rows.sort(key=lambda row: (zlib.crc32(row["features"]), row["label"]))
    # Repeated documents are one bag.
    rows = [row for i, row in enumerate(rows) if not i or row != rows[i - 1]]
    bags = [np.frombuffer(row["features"], np.float16).reshape(-1, FEATURES) for row in rows]
    return fit(bags, np.array([row["label"] for row in rows], dtype=np.float64))


def scorer(model: Model):
    """Column function: score of every whole text, 0 to 1; null counts as empty and has a score too."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(text_scores(model, texts), pa.float64())

    return score


def scored(docs: DataFrame, labels: DataFrame, name: str = "score", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a score column: the higher, the likelier label 1.

    Every row keeps all its columns (a column of the score's name is replaced); repeated rows have
    equal scores; ids, languages, sources and labels are never inputs. Null and empty texts are one
    empty passage and have a score. A text of any length is scored whole. Without usable labels
    every score is 0.5. An empty table gives no rows.
    """
    model = learned(docs, labels, id_col, text_col)
    return docs.withColumn(name, scorer(model)(F.col(text_col).cast("string")))
