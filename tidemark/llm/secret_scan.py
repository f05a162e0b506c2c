"""Secret scans over a ledger of blobs.

Every version of every path is addressed by the hash of its content. The ledger holds, for each
blob, which rule at which version has scanned it and what it found; a run scans only the pairs of
blob and rule version that the ledger does not hold, once per blob however many paths carry it,
and joins findings back to all paths.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.runtime import scratch_path


class Rule(NamedTuple):
    """A pattern, the group whose length counts (0: the whole match) and its least length."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


# Kinds, patterns and lengths that the results are defined by.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)

LEDGER_SCHEMA = "blob string, results array<struct<rule:string,version:int,starts:array<int>,ends:array<int>>>"


def matcher(rule: Rule):
    """Spans of a rule in a text: leftmost matches that do not overlap, too short ones dropped."""
    if rule.group == 0 and re.fullmatch(r"\[[^\]]*\]\+", rule.pattern):
        # A run of one class: only long runs need to be visited.
        search = re.compile(f"{rule.pattern[:-1]}{{{rule.least},}}", re.ASCII).finditer
        return lambda text: [match.span() for match in search(text)]
    search = re.compile(rule.pattern, re.ASCII).finditer
    return lambda text: [m.span() for m in search(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def blob_of(text: Column | str) -> Column:
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256)


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def tag(rule: Rule) -> str:
    return f"{rule.name}@{rule.version}"


def scan_unseen(versions: DataFrame, ledger: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: one per blob that a rule at its present version has not scanned yet."""
    tags = [tag(rule) for rule in rules]

    @F.pandas_udf("array<struct<rule:string,version:int,starts:array<int>,ends:array<int>>>")
    def scanned(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        finders = [(rule, matcher(rule)) for rule in rules]
        rows = []
        for text, todo in zip(texts, wanted):
            found = []
            for rule, find in finders:
                if tag(rule) in todo:
                    spans = find(text)
                    found.append((rule.name, rule.version, [a for a, _ in spans], [b for _, b in spans]))
            rows.append(found)
        return pd.Series(rows)

    blobs = versions.select(
        blob_of(text_col).alias("blob"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).dropDuplicates(["blob"])
    done = ledger.select("blob", F.explode("results").alias("r")).groupBy("blob").agg(
        F.collect_set(F.concat_ws("@", "r.rule", "r.version")).alias("done")
    )
    todo = F.array_except(F.array(*map(F.lit, tags)), F.coalesce("done", F.array().cast("array<string>")))
    return (
        blobs.join(done, "blob", "left")
        .select("blob", "text", todo.alias("todo"))
        .where(F.size("todo") > 0)
        .select("blob", scanned("text", "todo").alias("results"))
    )


def paths_with_findings(
    versions: DataFrame, ledger: DataFrame, path_cols: list[str], text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Rows (path..., blob, findings) for every version of every path, from the present rule versions.

    ``findings`` is an array of (start, kind, rule, end) by start, then by the rules' order.
    """
    ranks = F.create_map(*[x for i, rule in enumerate(rules) for x in (F.lit(tag(rule)), F.lit(i))])
    wanted = ledger.select("blob", F.explode("results").alias("r")).withColumn("kind", ranks[F.concat_ws("@", "r.rule", "r.version")])
    spans = F.transform(
        F.arrays_zip("r.starts", "r.ends"),
        lambda span: F.struct(
            span["starts"].alias("start"), F.col("kind").alias("kind"), F.col("r.rule").alias("rule"), span["ends"].alias("end")
        ),
    )
    # A pair scanned twice (a run repeated after a failure) counts once.
    found = wanted.where(F.col("kind").isNotNull()).groupBy("blob").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(spans)))).alias("findings")
    )
    return versions.select(*path_cols, blob_of(text_col).alias("blob")).join(found, "blob", "left").select(
        *path_cols, "blob", F.coalesce("findings", F.array().cast("array<struct<start:int,kind:int,rule:string,end:int>>")).alias("findings")
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path; an empty one where nothing was written yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_ledger(spark)


def scan(
    versions: DataFrame,
    ledger_path: str | None = None,
    path_cols: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Bring the ledger at ``ledger_path`` up to date and return findings of all paths.

    The ledger is a parquet folder that only grows; it is begun where there is none, in the shared scratch folder
    when no path is given. Null texts count as empty. Empty texts, rows without findings and null
    paths keep their row with an empty array; repeated rows stay repeated; an empty table gives no
    rows. Other columns are not read. Positions are code points, ends exclusive.
    """
    spark = versions.sparkSession
    if ledger_path is None:
        ledger_path, known = scratch_path(spark, "ledger"), empty_ledger(spark)
    else:
        known = read_ledger(spark, ledger_path)
    scan_unseen(versions, known, text_col, rules).write.mode("append").parquet(ledger_path)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    return paths_with_findings(versions, ledger, list(path_cols), text_col, rules)
