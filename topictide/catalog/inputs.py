"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topictide.functions import text as T
from topictide.operators import keywords, slicing
from topictide.session import use_utc

# A short stopword list of our own.
STOPWORDS = ("the", "of", "and", "is", "to", "in", "de", "la", "le", "les", "un", "une", "der", "die", "das", "und", "el", "los")
EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Shuffle a table of fewer files than cores over all cores; larger ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df


def r6(column: str | Column) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, published, title, summary, authors, link): dated records from ``documents``."""
    text, at = F.col("text"), F.instr("text", "\n")
    days = F.make_dt_interval((F.col("doc_id") % 180).cast("int"))
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id",
        (F.timestamp_seconds(F.lit(EPOCH)) + days).alias("published"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(at > 0, F.substr(text, at + 1)).otherwise("").alias("summary"),
        F.col("source").alias("authors"),
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("link"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their cleaned ``text``."""
    text = T.clean_text(T.join_title_summary(F.col("title"), F.col("summary")))
    return documents(spark, sf_dir).select("doc_id", "published", "title", text.alias("text"))


def sliced(spark: SparkSession, sf_dir: str, freq: str = "monthly") -> DataFrame:
    return slicing.with_slice(cleaned(spark, sf_dir), freq)


def fixture_topic(doc_id: str = "doc_id") -> Column:
    """A topic per document where no clustering is wanted; -1 occurs."""
    return (F.col(doc_id) % 7 - 1).cast("int")


def topic_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sliced(spark, sf_dir).withColumn("topic", fixture_topic())
    return keywords.bags(docs)


def with_label(df: DataFrame, freq: str = "monthly") -> DataFrame:
    """Replace the slice timestamp by its label."""
    from topictide.functions.dates import slice_label

    label = slice_label(F.col("slice"), freq).alias("slice_label")
    return df.select(label, *[c for c in df.columns if c not in ("slice", "slice_label")])
