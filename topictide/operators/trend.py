"""Keyword-flagged topics against stable baseline topics, and topic positions.

Documents are aggregated to (slice, topic) once; everything after works on that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------
TREND_KEYWORDS = ("transformer", "llm", "language model", "gpt")
STABLE_SHARE = 0.6
FLAGGED_LABEL = "llm_related"
BASELINE_LABEL = "baseline"
# ---- end of fixed values ------------------------------------------------------------

TREND_PATTERN = "|".join(TREND_KEYWORDS)


def topic_text(topic_terms: DataFrame) -> DataFrame:
    """(slice, topic, text): the terms of a topic in rank order, joined by blanks."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return (
        topic_terms.groupBy("slice", "topic")
        .agg(ranked.alias("_terms"))
        .select("slice", "topic", F.array_join(F.transform("_terms", lambda t: t["term"]), " ").alias("text"))
    )


def flagged_topics(topic_terms: DataFrame, pattern: str = TREND_PATTERN) -> DataFrame:
    """(slice, topic) whose joined terms match the pattern in any case.

    The match may span two neighbouring terms.
    """
    return topic_text(topic_terms).where(F.col("text").rlike(f"(?i)({pattern})")).select("slice", "topic")


def topic_counts(doc_topics: DataFrame) -> DataFrame:
    """(slice, topic, doc_count), noise included."""
    return doc_topics.groupBy("slice", "topic").agg(F.count("*").alias("doc_count"))


def topic_slices(topic_terms: DataFrame) -> DataFrame:
    return topic_terms.select("slice").distinct()


def counted_slices(doc_topics: DataFrame, topic_terms: DataFrame) -> DataFrame:
    """Topic counts of the slices that have a topic result at all."""
    return topic_counts(doc_topics).join(F.broadcast(topic_slices(topic_terms)), "slice", "left_semi")


def topic_presence(counts: DataFrame) -> DataFrame:
    """(topic, n_slices): number of slices a topic id occurs in."""
    return counts.groupBy("topic").agg(F.count_distinct("slice").alias("n_slices"))


def stable_topics(counts: DataFrame, topic_terms: DataFrame, share: float = STABLE_SHARE) -> DataFrame:
    """(topic, n_slices) present in at least floor(share * topic slices) slices."""
    n = topic_slices(topic_terms).agg(F.floor(F.lit(float(share)) * F.count("*")).alias("n"))
    return topic_presence(counts).where(F.col("n_slices") >= n.scalar())


def baseline_topics(stable: DataFrame, flagged: DataFrame) -> DataFrame:
    """(topic): stable ids never flagged in any slice."""
    return stable.select("topic").join(flagged.select("topic").distinct(), "topic", "left_anti")


def trend_summary(
    topic_terms: DataFrame,
    doc_topics: DataFrame,
    pattern: str = TREND_PATTERN,
    stable_share: float = STABLE_SHARE,
) -> DataFrame:
    """(slice, topic, label, doc_count) of the flagged and the baseline topics."""
    flagged = flagged_topics(topic_terms, pattern)
    counts = counted_slices(doc_topics, topic_terms)
    baseline = baseline_topics(stable_topics(counts, topic_terms, stable_share), flagged)
    label = F.when(F.col("_flagged"), FLAGGED_LABEL).when(F.col("_baseline"), BASELINE_LABEL)
    return (
        counts.join(flagged.withColumn("_flagged", F.lit(True)), ["slice", "topic"], "left")
        .join(baseline.withColumn("_baseline", F.lit(True)), "topic", "left")
        .withColumn("label", label)
        .where(F.col("label").isNotNull())
        .select("slice", "topic", "label", "doc_count")
    )


def topic_positions(topic_terms: DataFrame, doc_layout: DataFrame) -> DataFrame:
    """(slice, topic, keyword, score, x, y): topic terms at the mean of their documents.

    ``doc_layout`` is (slice, doc_id, topic, x, y); topics without coordinates drop out.
    """
    xy = (
        doc_layout.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("slice", "topic")
        .agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    )
    return topic_terms.join(xy, ["slice", "topic"]).select(
        "slice", "topic", F.col("term").alias("keyword"), "score", "x", "y"
    )
