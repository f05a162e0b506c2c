"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic class). Raking scales the cells in turn until
their margins meet the targets, never above the tokens that a cell has; documents are then kept
with the probability of their cell. Classes are those named in the targets and one for the rest,
so the table that is raked is bounded by the targets, whatever the number of documents or sources.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "(rest)"
SWEEPS = 40


class Margin(NamedTuple):
    """A class expression and the wanted share of tokens of each named class.

    Classes that are not named, and unknown ones, share what the named ones leave, 1 - sum(targets), in one
    class. Where nothing is left, this class is to keep its own share of tokens, and the named shares are those
    of the other tokens.
    """

    name: str
    expression: Column
    targets: dict[str, float]

    def classed(self) -> Column:
        known = self.expression.cast("string")
        return F.when(known.isin(*self.targets), known).otherwise(F.lit(REST))


def words_of(text: str) -> Column:
    """Tokens of a document: its words divided by spaces; 0 for null and empty texts."""
    column = F.col(text).cast("string")
    return F.when(column.isNull() | (column == ""), 0).otherwise(F.size(F.split(column, " "))).cast("long")


def raked(cells: np.ndarray, tokens: np.ndarray, targets: list[np.ndarray], total: float, sweeps: int = SWEEPS) -> np.ndarray:
    """Kept tokens of each cell.

    cells[i, m] is the class of cell i in margin m; targets[m] holds the shares of the classes.
    Classes without tokens cannot be met: the shares of the others are raised in proportion, or, where
    these are all 0, follow their tokens. A
    sweep scales the cells to each margin in turn and then takes back what a cell does not have.
    """
    kept = tokens.astype(float) * (total / tokens.sum()) if tokens.sum() else np.zeros(len(tokens))
    for _ in range(sweeps if tokens.sum() else 0):
        for margin, shares in enumerate(targets):
            there = np.bincount(cells[:, margin], weights=tokens, minlength=len(shares))
            wanted = np.where(there > 0, shares, 0.0)
            wanted = wanted if wanted.sum() else there
            wanted = wanted / wanted.sum() * total
            have = np.bincount(cells[:, margin], weights=kept, minlength=len(shares))
            kept = kept * np.divide(wanted, have, out=np.zeros(len(shares)), where=have > 0)[cells[:, margin]]
        kept = np.minimum(kept, tokens)
    return kept


def with_rest(shares: np.ndarray, classes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The shares of the named classes and, last, of the rest: what they leave, or else the rest's own share of tokens."""
    left = 1 - shares.sum()
    if left > 1e-9 or not tokens.sum():
        return np.array([*shares, max(0.0, left)])
    there = np.bincount(classes, weights=tokens, minlength=len(shares) + 1)
    own = there[-1] / there.sum()
    # Shares of named classes without tokens go to the other named ones.
    named = np.where(there[:-1] > 0, shares, 0.0)
    return np.array([*(named / (named.sum() or 1) * (1 - own)), own])


def uniform(id_col: Column | str, seed: str) -> Column:
    """A number from 0 to 1 (below it) fixed by the id and the seed; null ids have the number of the empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(column.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def mixed(
    docs: DataFrame,
    margins: list[Margin],
    share: float,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    seed: str = "mix:",
    sweeps: int = SWEEPS,
    prefix: str = "mix_",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with (mix_<margin>..., mix_tokens, mix_probability, mix_kept).

    ``share`` of all tokens is to be kept, divided as the margins' targets want. A document is kept
    with the probability of its cell, by a number drawn from its id, so repeated rows and rows with
    equal ids are decided alike. Null or unknown classes are in the class of the rest, which has a share
    of its own also where the targets leave none. Documents
    without tokens are kept with the probability of their cell (0 if the cell has no tokens).
    Columns of the names above (``prefix`` may set them apart) are replaced; all others stay. An empty table gives no rows.
    """
    counted = docs.withColumns({f"{prefix}{m.name}": m.classed() for m in margins}).withColumn(
        f"{prefix}tokens", words_of(text_col) if tokens is None else tokens
    )
    names = [f"{prefix}{m.name}" for m in margins]
    # At most the product of the numbers of classes.
    rows = counted.groupBy(*names).agg(F.sum(f"{prefix}tokens").alias("tokens")).collect()
    rows.sort(key=lambda row: tuple(row[n] for n in names))
    classes = [[*m.targets, REST] for m in margins]
    cells = np.array([[c.index(row[n]) for c, n in zip(classes, names)] for row in rows], dtype=int).reshape(len(rows), len(margins))
    amounts = np.array([row["tokens"] or 0 for row in rows], dtype=float)
    shares = [with_rest(np.array([*m.targets.values()]), cells[:, i], amounts) for i, m in enumerate(margins)]
    kept = raked(cells, amounts, shares, share * amounts.sum(), sweeps)
    chances = np.divide(kept, amounts, out=np.zeros(len(rows)), where=amounts > 0)
    key = F.concat_ws("\x1f", *names)
    if len(rows):
        table = F.create_map(*[x for row, p in zip(rows, chances) for x in (F.lit("\x1f".join(row[n] for n in names)), F.lit(round(float(p), 6)))])
        chance = F.coalesce(table[key], F.lit(0.0))
    else:
        chance = F.lit(0.0)
    return counted.withColumn(f"{prefix}probability", chance).withColumn(
        f"{prefix}kept", uniform(id_col, seed) < F.col(f"{prefix}probability")
    )


# --- what the registered query and the pipeline ask for --------------------------------------

LANGUAGES = {"en": 0.62, "de": 0.14, "fr": 0.14, "es": 0.10}
SOURCES = {f"src{i}": 0.05 for i in range(20)}
TOPICS = {"prose": 0.86, "licensed": 0.06, "tabular": 0.04}


def topic_of(text: str) -> Column:
    """A coarse topic from the marks of a text: license lines, tables, else prose; null and empty texts are prose."""
    column = F.col(text).cast("string")
    return (
        F.when(F.contains(column, F.lit("icense")), "licensed").when(F.contains(column, F.lit(" | ")), "tabular").otherwise("prose")
    )


def corpus_margins() -> list[Margin]:
    return [
        Margin("source", F.col("source"), SOURCES),
        Margin("lang", F.col("lang"), LANGUAGES),
        Margin("topic", topic_of("text"), TOPICS),
    ]


SHARE = 0.7
