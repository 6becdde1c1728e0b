"""Top-n per group without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this n Spark itself keeps only n rows per group and map task before it shuffles
# (spark.sql.optimizer.windowGroupLimitThreshold).
MAP_SIDE_LIMIT = 1000
SALTS = 64


def top_n(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    n: int,
    rank_col: str = "rank",
    salt_on: list[str] | None = None,
) -> DataFrame:
    """The first ``n`` rows of every group in ``order``, numbered from 1.

    ``order`` must be total within a group (end with a unique column). For a large ``n`` a
    hot group is first cut to n rows per salt, so no task sorts the whole group; the rows
    kept are the same either way.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    if n > MAP_SIDE_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*(salt_on or df.columns)), F.lit(SALTS)))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_part_rank", F.row_number().over(part))
            .where(F.col("_part_rank") <= n)
            .drop("_salt", "_part_rank")
        )
    return df.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) <= n)
