"""Session defaults and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows of a narrow table that may be sent to every task: some 20 MB.
BROADCAST_ROWS = 200_000


def get_session(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; keyword names use '__' for dots."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A small partition can stand for a lot of work here: pairs and paths fan out.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Checkpoints go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A temporary one is made only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tessera-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


# Whether the shuffle files of a plan go when its run ends.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _files_go(spark: SparkSession) -> Iterator[None]:
    """Plans made and run in here remove their shuffle files at the end of the run."""
    before = spark.conf.get(FILES_GO, None)
    spark.conf.set(FILES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FILES_GO)
        else:
            spark.conf.set(FILES_GO, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Run the plan once, keep its rows in the shared folder and start a new lineage there. The shuffle
    files of that run go with its end: nothing reads them again."""
    shared_dir(df.sparkSession)
    with _files_go(df.sparkSession):
        # A plan of its own: what `df` itself shuffles when it is run again is left alone.
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As `checkpointed`, for many rows: a compressed table, a fraction of the size of plain rows. How rows
    are dealt out to tasks is not kept."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"rows-{uuid.uuid4().hex}")
    with _files_go(spark):
        df.select("*").write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a table whose counted rows allow it; beyond that the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores when the input has fewer splits than that, as one unsplittable
    file does. With many files nothing happens."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
