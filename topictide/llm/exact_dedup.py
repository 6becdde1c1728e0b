"""Exact deduplication: group by a 128-bit content hash, keep one stable id, compare the bytes.

Rows are grouped by (hash, text): the hash decides almost every comparison and rows of one hash
are equal only if their bytes are. Copies collapse before the shuffle, so a text that makes up a third of
the table arrives once per task. Only ids and digests are joined back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.llm.bloom import keep_rows
from topictide.llm.common import ascii_lower, hash128, text_of
from topictide.session import materialise


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise: Callable[[Column], Column] = ascii_lower,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    ``keep`` is ``min`` or ``max``: the id that stays of equal texts. A null text counts as empty. Rows that
    repeat an id with an equal text are told apart by nothing, so exactly one of them is kept. Null ids
    come after all others; in a group of nothing else ``keep_id`` is null and one row is kept. An empty
    table gives an empty result; other columns are not read.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    best = F.min if keep == "min" else F.max
    text = normalise(text_of(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", hash128(F.col("text")).alias("hash"))
    groups = (
        rows.groupBy("hash", "text")
        .agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
    )
    groups = materialise(groups, "exact-groups")
    ids = rows.select("id", "hash", F.sha2("text", 256).alias("sha"))
    keys = ["hash", "sha"]
    if not groups.groupBy(*keys).count().where("count > 1").isEmpty():
        # two different texts share both digests: join on their bytes
        groups = rows.groupBy("hash", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        ids, keys = rows.withColumn("sha", F.sha2("text", 256)), ["hash", "text"]
    ids = ids.groupBy("id", "sha", *[k for k in keys if k != "sha"]).agg(F.count(F.lit(1)).alias("n"))
    joined = ids.join(groups, keys).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return joined.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise: Callable[[Column], Column] = ascii_lower,
) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    judged = exact_dedup(docs, id_col, text_col, keep, normalise)
    keys = {"_id": F.col(id_col), "_sha": F.unhex(F.sha2(normalise(text_of(text_col)), 256))}
    return keep_rows(docs, keys, judged.select(F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_sha"), "kept"))
