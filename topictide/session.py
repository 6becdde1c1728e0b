"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The settings every topictide job relies on; all of them are plain Spark options.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "topictide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings (``conf`` wins; dots as double underscores)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All slice arithmetic is in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Rows and bytes sent to a Python worker at a time.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def small_batches(spark: SparkSession | None = None) -> None:
    """Send few rows at a time to Python workers of this session: texts are long, and the default of 10,000 rows would keep all
    of them, once in every step of a worker, in its memory."""
    conf = (spark or SparkSession.active()).conf
    for name, limit in BATCH_LIMITS.items():
        if not 0 < int(conf.get(name).rstrip("bB")) <= limit:
            conf.set(name, str(limit))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``.

    Only where the session names none (tests, a single machine) a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if base:
        return base.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "topictide")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_scratch: ContextVar[str | None] = ContextVar("topictide_scratch", default=None)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (inside ``scratch``, below that run's own)."""
    return f"{_scratch.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """A folder for all intermediate tables of one run, deleted when the run ends.

    Tables that are still lazily defined on them have to be written before that.
    """
    folder = work_path(spark, name)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        remove(spark, folder)


# Files of a write's shuffles go as soon as it has ended, not when the driver's garbage is collected.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage for iterative jobs and shares an expensive table between branches. The
    written files outlive any executor, unlike cached or locally checkpointed blocks. The shuffles of the write leave nothing behind.
    """
    path = work_path(df.sparkSession, name)
    _written(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _written(df: DataFrame, path: str) -> None:
    with _shuffles_removed(df.sparkSession):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def numbered(df: DataFrame, name: str, column: str) -> DataFrame:
    """Materialise ``df`` with its rows numbered in order, from 0 and without gaps, in ``column``."""
    stored = materialise(df.withColumn(column, F.monotonically_increasing_id()), name)
    task, place = F.shiftright(column, 33), F.col(column).bitwiseAND((1 << 33) - 1)
    first, total = [], 0
    # one row for each task of the write
    for r in sorted(stored.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()):
        first.append((r["task"], total))
        total += r["n"]
    starts = df.sparkSession.createDataFrame(first, "_task long, _first long")
    return stored.join(F.broadcast(starts), task == F.col("_task")).withColumn(column, F.col("_first") + place).drop("_task", "_first")


def materialise_only(spark: SparkSession, name: str, *builds: Callable[[], DataFrame]) -> tuple[DataFrame, ...]:
    """Materialise what ``builds`` give, in turn; all other tables that they store on the way are deleted."""
    paths = [work_path(spark, name) for _ in builds]
    schemas = []
    with scratch(spark, f"{name}-steps"):
        for build, path in zip(builds, paths):
            df = build()
            schemas.append(df.schema)
            _written(df, path)
    return tuple(spark.read.schema(s).parquet(p) for s, p in zip(schemas, paths))
