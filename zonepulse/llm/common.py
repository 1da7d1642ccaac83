"""Reading, durable intermediate tables, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 22  # of an Arrow batch of wide rows
BATCH_ROWS = 64  # rows of a Parquet file that are decoded at once
FILE_ROWS = 1 << 13  # narrow rows that a file of a table of known size holds at least


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where it is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def files(rows: int) -> int:
    """Files that so many narrow rows fill."""
    return max(1, -(-rows // FILE_ROWS))


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have at most about so many narrow ``rows``, in no more tasks, and so files,
    than they fill."""
    return df.coalesce(files(rows))


def durable(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: later steps don't
    recompute it, and a lost executor loses nothing of it.  Where it is known to have at most
    so many narrow ``rows``, they are not dealt over more files than they fill."""
    spark = df.sparkSession
    if rows is not None:
        df = few(df, rows)
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots written as ``__``) for the jobs started inside."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def durable_freed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``durable``; Spark removes the shuffle files of the write as soon as it is done."""
    with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return durable(df, rows)


def small_batches(spark: SparkSession):
    """Arrow and Parquet batches of wide rows stay small in the jobs started inside."""
    return settings(
        spark,
        spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES),
        spark__sql__parquet__columnarReaderBatchSize=str(BATCH_ROWS),
    )


def durable_once(df: DataFrame) -> DataFrame:
    """``durable_freed``, and Arrow and Parquet batches of wide rows stay small."""
    with small_batches(df.sparkSession):
        return durable_freed(df)


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """Connected components of ``links`` (a, b long), at most ``rows``, if that is known: (id,
    root), root being one vertex of the component, for every vertex that occurs.

    Contraction: in each round every vertex moves to the neighbour (or itself) that comes
    first in a pseudo-random order of the round, and the links between what is left go on.
    Random orders shrink paths and stars alike, so the rounds grow with the logarithm of
    the vertices.  Sums per vertex are combined before the shuffle, so a vertex with very
    many links is no hot spot; every round is written to the shared folder.
    """
    spark = links.sparkSession
    links = durable(
        links.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        rows,
    )
    vertices = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id")))
    n = links.count()
    most, turn = 2 * n, 0
    out = durable(vertices.distinct().select("id", F.col("id").alias("root")), most)
    while n:
        turn += 1
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("o"), F.col(c).alias("v"))  # noqa: B023, E731
        ends = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
        moved = durable(
            ends.groupBy("a")
            .agg(F.min(order("b")).alias("m"))
            .select(
                F.col("a").alias("old"),
                F.least(F.col("m"), order("a")).getField("v").alias("new"),
            ),
            2 * n,
        )
        left = moved.select(F.col("old").alias("a"), F.col("new").alias("a2"))
        right = moved.select(F.col("old").alias("b"), F.col("new").alias("b2"))
        links = durable(
            links.join(left, "a").join(right, "b").where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct(),
            n,
        )
        out = durable(
            out.join(moved, F.col("root") == F.col("old"), "left")
            .select("id", F.coalesce("new", "root").alias("root")),
            most,
        )
        n = links.count()
    return out
