"""Time slices as a grouping key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topictide.functions.dates import slice_label, slice_start


def with_slice(docs: DataFrame, freq: str, date_col: str = "published") -> DataFrame:
    """Add ``slice`` and ``slice_label``; documents without a date drop out."""
    return (
        docs.where(F.col(date_col).isNotNull())
        .withColumn("slice", slice_start(F.col(date_col), freq))
        .withColumn("slice_label", slice_label(F.col("slice"), freq))
    )


def slice_sizes(docs: DataFrame) -> DataFrame:
    """Documents per slice."""
    return docs.groupBy("slice").agg(F.count("*").alias("n_docs"))


def slices_with_min_docs(docs: DataFrame, n: int = 15) -> DataFrame:
    """Documents of the slices holding at least ``n`` documents.

    Counting first and joining the counts back keeps a hot slice spread over all tasks; a
    window over the slice would gather it in one. There is at most one count per calendar
    day (3.7 million in ten thousand years), hence the broadcast.
    """
    big = slice_sizes(docs).where(F.col("n_docs") >= n).select("slice")
    return docs.join(F.broadcast(big), "slice", "left_semi")
