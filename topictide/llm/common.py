"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else. Pure ASCII text, the common case, takes the faster function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """Whether a row belongs to the held-out fold; rows without an id never do."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % modulus == remainder, F.lit(False))


def hash128(text: Column) -> Column:
    """MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def parts_for(rows: int, per_part: int) -> int:
    """How many parts of about ``per_part`` rows."""
    return max(1, -(-rows // per_part))


BATCH_RECORDS = 1000


def small_batches(spark: SparkSession | None = None) -> None:
    """Send at most ``BATCH_RECORDS`` rows at a time to Python workers of this session: texts are long, and the default
    of 10,000 rows would keep tens of megabytes of them in every buffer on the way."""
    conf = (spark or SparkSession.active()).conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_RECORDS:
        conf.set(name, str(BATCH_RECORDS))


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def release_memory() -> None:
    """Give memory that this Python process no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for ``mapInArrow``, whose task leaves no unused memory behind: workers outlive their tasks, and what they hold
    adds to the executor's memory in all later steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run
