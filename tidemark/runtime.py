"""Session settings, the shared scratch folder and size-checked join sides."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it has been counted and found at or below this many rows.
BROADCAST_ROWS = 100_000


def local_session(cores: str = "8", app: str = "tidemark") -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session that names none may fall back to a folder of this machine; executors
    of a cluster could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _own_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Databases of the lifetimes that are open, the innermost last.
_lifetimes: ContextVar[tuple[str, ...]] = ContextVar("lifetimes", default=())


def _database() -> str | None:
    return (None, *_lifetimes.get())[-1]


@contextmanager
def lifetime(spark: SparkSession) -> Iterator[None]:
    """Intermediates written inside are gone afterwards; what is to stay is written inside with :func:`kept` or a writer.

    They are tables of a database of their own in the shared folder, which Spark drops as a whole, also after a failure.
    A frame that was not written yet must not be used any more. Inside another lifetime the inner one holds.
    """
    name = f"tidemark_run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_root(spark).rstrip('/')}/{name}'")
    token = _lifetimes.set((*_lifetimes.get(), name))
    try:
        yield
    finally:
        _lifetimes.reset(token)
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def handed_on(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``stored`` in the lifetime around the present one, or for good where there is none."""
    token = _lifetimes.set(_lifetimes.get()[:-1])
    try:
        return stored(df, label, **options)
    finally:
        _lifetimes.reset(token)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as it ends, not when the driver next collects garbage.

    Meant for writes, whose plans run once: a frame run again would shuffle again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: the plan of what follows starts here."""
    spark = df.sparkSession
    if _database() is not None:
        return stored(df, "cut")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)


def settled(df: DataFrame, **facts: Column) -> tuple[DataFrame, Row]:
    """Checkpoint a small intermediate and return it with its row count and further aggregates.

    Later plans start from it and know its size. A lost executor costs nothing: the rows are in
    the shared folder. Only the one row of aggregates comes to the driver.
    """
    kept = cut_lineage(df)
    measured = [F.count(F.lit(1)).alias("rows"), *[fact.alias(name) for name, fact in facts.items()]]
    return kept, kept.agg(*measured).first()


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a join side that is known to have at most ``rows`` rows.

    Above the limit there is no hint: Spark shuffles both sides, and adaptive execution splits
    the skewed partitions of the large one.
    """
    return F.broadcast(df) if rows <= limit else df


def join_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Settle and count a side of unknown size, then treat it by its count."""
    kept, facts = settled(df)
    return small(kept, facts["rows"], limit)


def kept(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write rows to a parquet table in the shared folder that no lifetime ends. ``options`` are those of the writer."""
    path = scratch_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write rows that several passes read to a parquet table in the shared folder.

    The passes then read only the columns they need, with their filters pushed down. Inside a :func:`lifetime` the
    table goes with it.
    """
    database = _database()
    if database is None:
        return kept(df, label, **options)
    name = f"{database}.{label.replace('-', '_')}_{uuid.uuid4().hex}"
    with freed_shuffles(df.sparkSession):
        df.write.options(**options).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def written(df: DataFrame, label: str, **facts: Column) -> tuple[DataFrame, Row]:
    """``stored``, with the row count and further aggregates of what was written."""
    kept = stored(df, label)
    measured = [F.count(F.lit(1)).alias("rows"), *[fact.alias(name) for name, fact in facts.items()]]
    return kept, kept.agg(*measured).first()


@contextmanager
def bucketed(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """Write rows once by the hash of a key: joins and groups by this key need no shuffle of them.

    Spark knows buckets of catalogue tables only. The table lives for the block of the ``with``: its rows
    and its entry are gone afterwards, so what is computed from it is to be written inside.
    """
    spark = df.sparkSession
    database = _database()
    name = f"{database + '.' if database else ''}tidemark_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").bucketBy(buckets, key).option("compression", "zstd")
    try:
        # A table without a path of its own belongs to the catalogue, which removes its rows with it.
        with freed_shuffles(spark):
            writer.saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def unused_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of the frame has, in any case of letters."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def once(expression: Column) -> Column:
    """Compute a costly column one time per row.

    A filter on a plain column is pushed below the projection and computes it again, for every
    place it is mentioned. Nothing is pushed below a generator; this one gives one row per row.
    """
    return F.explode(F.array(expression))
