"""Rows told apart by a Bloom filter of bounded size before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.llm.url_filter import bloom_blocks, blocks_for, possible
from topictide.session import materialise


def probed(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with ``possible``, false where the keys are not in ``wanted``."""
    digest = F.xxhash64(*keys)
    n_blocks = blocks_for(wanted.count())
    blocks = bloom_blocks(wanted.select(digest.alias("_digest")), n_blocks, "_digest")
    return possible(rows.withColumn("_digest", digest), "_digest", blocks, n_blocks).drop("_digest")


def only(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys may be in ``wanted``."""
    return probed(rows, wanted, *keys).where("possible").drop("possible")


def join_counted(rows: DataFrame, wanted: DataFrame, key: str, n_wanted: int | None = None, most: int = 300_000) -> DataFrame:
    """``rows`` joined with ``wanted``, a stored table of ``n_wanted`` rows: broadcast if that is at most ``most``, else behind a filter."""
    if (wanted.count() if n_wanted is None else n_wanted) <= most:
        return rows.join(F.broadcast(wanted), key)
    return only(rows, wanted, key).join(wanted, key)


def keep_rows(docs: DataFrame, keys: dict[str, Column], judged: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns: ``judged`` has ``keys`` and ``kept`` for every row.

    Single rows that are kept never leave their place. Only the others, told apart by a filter, are shuffled: of the rows of
    a key that is kept at least once, one stays. Nulls in keys are equal."""
    judged = materialise(judged.select(*keys, "kept"), "judged")
    counts = judged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_and("kept").alias("all_kept"))
    doubtful = counts.where("n > 1 or not all_kept").select(*keys)
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in keys.items()])
    split = probed(rows, materialise(doubtful, "doubtful"), *keys)
    unsure, wanted = split.where("possible"), judged.where("kept").select(*keys).distinct()
    same = F.lit(True)
    for name in keys:
        same = same & unsure[name].eqNullSafe(wanted[name])
    some = unsure.join(wanted, same, "left_semi").dropDuplicates(list(keys))
    return split.where("not possible").unionByName(some).select("row.*")
